"""Independent DuckDB SQL for each registered query.

The driver registers the base tables as views; the fixture views are inlined
here as CTEs. Conventions: keys and counts are cast to BIGINT, calendar parts
to INTEGER (Spark's types), doubles rounded where the two engines may sum in a
different order, and every computed column is aliased to the Spark name.
DuckDB's `dayofweek` is 0 = Sunday, Spark's 1 = Sunday, hence the `+ 1`.
"""

from __future__ import annotations

# --- fixture views ----------------------------------------------------------

# Ridge on (hour, hourly_ridership) -> pu_hourly, fully in SQL: 5-fold grid
# over alpha (validation MSE computed row by row), best alpha, refit on all
# training rows, closed-form 2x2 solve. One row per (alpha): mean_mse, plus
# the refit's coefficients on every row.
RIDGE_BODY = """
  WITH tr AS MATERIALIZED (
    SELECT CAST(hour AS DOUBLE) AS x1, CAST(hourly_ridership AS DOUBLE) AS x2,
           CAST(pu_hourly AS DOUBLE) AS y, fold
    FROM split_o WHERE split = 'train'),
  m AS MATERIALIZED (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM tr),
  c AS MATERIALIZED (SELECT fold, x1 - (SELECT m1 FROM m) AS x1, x2 - (SELECT m2 FROM m) AS x2,
               y - (SELECT my FROM m) AS y FROM tr),
  fs AS MATERIALIZED (SELECT fold, count(*) AS n, sum(x1) AS s1, sum(x2) AS s2, sum(y) AS sy,
                sum(x1 * x1) AS s11, sum(x1 * x2) AS s12, sum(x2 * x2) AS s22,
                sum(x1 * y) AS s1y, sum(x2 * y) AS s2y
         FROM c GROUP BY fold),
  tot AS (SELECT -1 AS fold, sum(n) AS n, sum(s1) AS s1, sum(s2) AS s2, sum(sy) AS sy,
                 sum(s11) AS s11, sum(s12) AS s12, sum(s22) AS s22, sum(s1y) AS s1y,
                 sum(s2y) AS s2y FROM fs),
  trs AS (
    SELECT f.fold, unnest([1, 3, 5, 7, 9, 11, 13, 15]) AS alpha,
           t.n - f.n AS n, t.s1 - f.s1 AS s1, t.s2 - f.s2 AS s2, t.sy - f.sy AS sy,
           t.s11 - f.s11 AS s11, t.s12 - f.s12 AS s12, t.s22 - f.s22 AS s22,
           t.s1y - f.s1y AS s1y, t.s2y - f.s2y AS s2y
    FROM fs f JOIN tot t ON t.fold <> f.fold),
  cc AS (SELECT fold, alpha, n, s1, s2, sy,
                s11 - s1 * s1 / n + alpha AS a11, s12 - s1 * s2 / n AS a12,
                s22 - s2 * s2 / n + alpha AS a22,
                s1y - s1 * sy / n AS b1, s2y - s2 * sy / n AS b2 FROM trs),
  sol AS (SELECT fold, alpha, n, s1, s2, sy,
                 (a22 * b1 - a12 * b2) / (a11 * a22 - a12 * a12) AS w1,
                 (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS w2 FROM cc),
  sol2 AS (SELECT fold, alpha, w1, w2, (sy - w1 * s1 - w2 * s2) / n AS b FROM sol),
  val AS (SELECT s.alpha, s.fold,
                 avg((c.y - s.b - s.w1 * c.x1 - s.w2 * c.x2)
                     * (c.y - s.b - s.w1 * c.x1 - s.w2 * c.x2)) AS mse
          FROM c JOIN sol2 s ON c.fold = s.fold GROUP BY s.alpha, s.fold),
  g AS MATERIALIZED (SELECT alpha, avg(mse) AS mean_mse FROM val GROUP BY alpha),
  best AS MATERIALIZED (SELECT alpha FROM g ORDER BY mean_mse, alpha LIMIT 1),
  fit AS (SELECT (SELECT alpha FROM best) AS alpha, n, s1, s2, sy,
                 s11 - s1 * s1 / n + (SELECT alpha FROM best) AS a11, s12 - s1 * s2 / n AS a12,
                 s22 - s2 * s2 / n + (SELECT alpha FROM best) AS a22,
                 s1y - s1 * sy / n AS b1, s2y - s2 * sy / n AS b2 FROM tot),
  w AS (SELECT alpha, n, s1, s2, sy,
               (a22 * b1 - a12 * b2) / (a11 * a22 - a12 * a12) AS w1,
               (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS w2 FROM fit),
  coef AS (SELECT alpha, w1, w2,
                  (SELECT my FROM m) + (sy - w1 * s1 - w2 * s2) / n
                    - w1 * (SELECT m1 FROM m) - w2 * (SELECT m2 FROM m) AS intercept
           FROM w)
  SELECT g.alpha, g.mean_mse, g.alpha = coef.alpha AS is_best,
         coef.alpha AS best_alpha, coef.w1, coef.w2, coef.intercept
  FROM g JOIN coef ON true"""

COMBINED_BODY = """
  SELECT coalesce(p.locationid, r.locationid) AS locationid,
         CAST(year(coalesce(p.hour_ts, r.hour_ts)) AS INTEGER) AS year,
         CAST(month(coalesce(p.hour_ts, r.hour_ts)) AS INTEGER) AS month,
         CAST(day(coalesce(p.hour_ts, r.hour_ts)) AS INTEGER) AS dayofmonth,
         CAST(dayofweek(coalesce(p.hour_ts, r.hour_ts)) + 1 AS INTEGER) AS dayofweek,
         CAST(hour(coalesce(p.hour_ts, r.hour_ts)) AS INTEGER) AS hour,
         CAST(coalesce(p.pu_hourly, 0) AS BIGINT) AS pu_hourly,
         CAST(coalesce(p.hourly_passengers, 0) AS BIGINT) AS hourly_passengers,
         CAST(coalesce(r.hourly_ridership, 0) AS BIGINT) AS hourly_ridership
  FROM pickups_zh_o p FULL OUTER JOIN ridership_zh_o r
    ON p.locationid = r.locationid AND p.hour_ts = r.hour_ts"""

VIEWS = {
    "trips_v": """
  SELECT CAST(1 + l.l_linenumber % 2 AS BIGINT) AS vendorid,
         o.o_orderdate AS pu_time, l.l_shipdate AS do_time,
         CAST(CASE WHEN l.l_orderkey % 50 = 0 THEN NULL ELSE l.l_linenumber END AS INTEGER)
           AS passenger_count,
         l.l_quantity AS trip_distance,
         CAST(1 + l.l_partkey % 7 AS INTEGER) AS ratecodeid,
         l.l_returnflag = 'R' AS store_and_fwd_flag,
         CAST(c.c_nationkey AS BIGINT) AS pulocationid,
         CAST(s.s_nationkey AS BIGINT) AS dolocationid,
         CAST(1 + l.l_suppkey % 7 AS INTEGER) AS payment_type,
         l.l_extendedprice AS fare_amount,
         l.l_discount - CAST(0.01 AS DOUBLE) AS extra,
         l.l_tax AS mta_tax,
         floor(l.l_extendedprice * l.l_discount * 100 + 0.5) / 100 AS tip_amount,
         floor(l.l_extendedprice * l.l_tax * 100 + 0.5) / 100 AS tolls_amount,
         CAST(0.3 AS DOUBLE) AS improvement_surcharge,
         o.o_totalprice AS total_amount,
         CAST(CASE WHEN l.l_linestatus = 'O' THEN 2.5 ELSE 0.0 END AS DOUBLE)
           AS congestion_surcharge,
         CAST(CASE WHEN c.c_nationkey = s.s_nationkey THEN 1.25 END AS DOUBLE) AS airport_fee
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "zone_attrs": """
  SELECT CAST(n_nationkey AS BIGINT) AS locationid, r_name AS borough, n_name AS zone
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "zones_kept": """
  SELECT locationid FROM zone_attrs WHERE borough IS NULL OR borough <> 'MIDDLE EAST'""",
    "pickups_v": """
  SELECT CAST(user_id % 25 AS BIGINT) AS pulocationid, ts AS pu_time,
         CAST(1 + event_id % 6 AS INTEGER) AS passenger_count
  FROM events WHERE event_type IN ('view', 'click', 'error')""",
    "ridership_v": """
  SELECT CAST(user_id AS VARCHAR) AS station_id, date_trunc('hour', ts) AS "timestamp",
         CAST(floor(value) AS BIGINT) AS ridership
  FROM events WHERE event_type IN ('purchase', 'signup')""",
    "event_trips_v": """
  SELECT ts AS pu_time,
         ts + to_minutes(CAST(event_id % 60 - 3 AS INTEGER)) AS do_time,
         CAST(CASE WHEN event_id % 50 = 0 THEN NULL ELSE 1 + event_id % 7 END AS INTEGER)
           AS passenger_count,
         value / 1e1 AS trip_distance, CAST(1 + CAST(floor(value) AS BIGINT) % 7 AS INTEGER) AS ratecodeid,
         CAST(user_id % 25 AS BIGINT) AS pulocationid, CAST(event_id % 25 AS BIGINT) AS dolocationid,
         CAST(1 + event_id % 4 AS INTEGER) AS payment_type, value + 3e0 AS fare_amount,
         5e-1 AS extra, 5e-1 AS mta_tax, value / 8e0 - 2.5e-1 AS tip_amount,
         value / 2e0 AS tolls_amount, value * 2e0 + 4e0 AS total_amount
  FROM events WHERE event_type IN ('view', 'click', 'error')""",
    "clean_pickups_o": """
  SELECT * FROM event_trips_v
  WHERE pu_time >= TIMESTAMP '2024-01-01 00:00:00' AND pu_time < TIMESTAMP '2024-02-01 00:00:00'
    AND pulocationid IN (SELECT locationid FROM zones_kept)
    AND dolocationid IN (SELECT locationid FROM zones_kept)
    AND pulocationid <= 263 AND dolocationid <= 263
    AND pu_time <> do_time AND pu_time < do_time
    AND trip_distance > 0 AND trip_distance <= 4.5e1
    AND tip_amount >= 0 AND tip_amount < total_amount
    AND fare_amount >= 2.5e0 AND total_amount >= 2.5e0 AND fare_amount < 5e2
    AND mta_tax >= 0 AND mta_tax <= 5e-1 AND tolls_amount >= 0 AND tolls_amount <= 2.5695e2
    AND extra >= 0 AND passenger_count > 0 AND passenger_count <= 6
    AND ratecodeid <= 6 AND payment_type <= 6""",
    "ridership_typed_o": """
  SELECT CAST(user_id AS VARCHAR) AS station_id, date_trunc('second', ts) AS "timestamp",
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(floor(value) AS INTEGER) END AS ridership
  FROM events WHERE event_type IN ('purchase', 'signup')""",
    "stations_v": """
  SELECT CAST(user_id AS VARCHAR) AS station_id,
         CAST(user_id * 91 % 1000 AS DOUBLE) / 100 AS latitude,
         CAST(user_id * 37 % 1000 AS DOUBLE) / 100 AS longitude
  FROM (SELECT DISTINCT user_id FROM events)""",
    "zones_v": """
  SELECT locationid, 0 AS ring, v.seq,
         CAST(locationid % 5 AS DOUBLE) * 2 + v.dx AS x,
         CAST(floor(locationid / 5) AS DOUBLE) * 2 + v.dy AS y
  FROM (SELECT locationid,
               unnest([{'seq': 0, 'dx': 1e-1, 'dy': 3e-1}, {'seq': 1, 'dx': 1.7e0, 'dy': 1e-1},
                       {'seq': 2, 'dx': 1.1e0, 'dy': 9e-1}, {'seq': 3, 'dx': 1.9e0, 'dy': 1.8e0},
                       {'seq': 4, 'dx': 4e-1, 'dy': 1.6e0}]) AS v
        FROM zone_attrs)""",
    "zones_m": """
  SELECT z.locationid, r.ring, r.seq, CAST(z.locationid % 5 AS DOUBLE) * 2 + r.dx AS x,
         CAST(floor(z.locationid / 5) AS DOUBLE) * 2 + r.dy AS y
  FROM zone_attrs z JOIN (VALUES
    (0, 1, 0, 6e-1, 8e-1), (0, 1, 1, 1e0, 8e-1), (0, 1, 2, 1e0, 1.2e0), (0, 1, 3, 6e-1, 1.2e0),
    (1, 2, 0, 12.2e0, 2e-1), (1, 2, 1, 13e0, 7e-1), (1, 2, 2, 13e0, 1.1e0), (1, 2, 3, 12.6e0, 1.1e0),
    (2, 0, 0, 1e-1, 3e-1), (2, 0, 1, 1.7e0, 1e-1), (2, 0, 2, 1.1e0, 9e-1), (2, 0, 3, 1.9e0, 1.8e0),
    (2, 0, 4, 4e-1, 1.6e0),
    (3, 2, 0, 7e-1, 9e-1), (3, 2, 1, 7e-1, 1.1e0), (3, 2, 2, 9e-1, 1.1e0), (3, 2, 3, 9e-1, 9e-1),
    (4, 2, 0, 12.2e0, 2e-1), (4, 2, 1, 13.8e0, 2e-1), (4, 2, 2, 13.8e0, 1.8e0), (4, 2, 3, 12.2e0, 1.8e0)
  ) r(ring, least, seq, dx, dy) ON z.locationid % 3 >= r.least""",
    # --- oracle-side derived tables (independent of the Spark operators) ---
    "edges_m": """
  SELECT a.locationid, a.ring, a.seq, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM (SELECT *, count(*) OVER (PARTITION BY locationid, ring) AS n FROM zones_m) a
  JOIN zones_m b ON b.locationid = a.locationid AND b.ring = a.ring AND b.seq = (a.seq + 1) % a.n""",
    "rings_m": """
  SELECT locationid, ring, count(*) AS n, sum(x1 * y2 - x2 * y1) / 2 AS area,
         min(x1) FILTER (WHERE seq = 1) AS cx, min(y1) FILTER (WHERE seq = 1) AS cy
  FROM edges_m GROUP BY locationid, ring""",
    # no ring's second corner lies on another ring
    "nesting_m": """
  SELECT r.locationid, r.ring, r.n, r.area, o.ring AS outer_ring, abs(o.area) AS outer_area
  FROM rings_m r LEFT JOIN (
    SELECT r.locationid, r.ring, e.ring AS outer_ring
    FROM rings_m r JOIN edges_m e ON e.locationid = r.locationid AND e.ring <> r.ring
     AND ((e.y1 > r.cy) <> (e.y2 > r.cy))
     AND r.cx < (e.x2 - e.x1) * (r.cy - e.y1) / (e.y2 - e.y1) + e.x1
    GROUP BY r.locationid, r.ring, e.ring HAVING count(*) % 2 = 1) h
    ON h.locationid = r.locationid AND h.ring = r.ring
  LEFT JOIN rings_m o ON o.locationid = h.locationid AND o.ring = h.outer_ring""",
    "parts_m": """
  SELECT d.*, s.part FROM (
    SELECT locationid, ring, any_value(n) AS n, any_value(area) AS area, count(outer_ring) AS depth,
           CASE WHEN count(outer_ring) % 2 = 1 THEN arg_min(outer_ring, outer_area) ELSE ring END AS shell
    FROM nesting_m GROUP BY locationid, ring) d
  JOIN (
    SELECT locationid, ring, row_number() OVER (PARTITION BY locationid ORDER BY ring) - 1 AS part
    FROM (SELECT locationid, ring FROM nesting_m GROUP BY locationid, ring HAVING count(outer_ring) % 2 = 0)) s
    ON s.locationid = d.locationid AND s.ring = d.shell""",
    "edges_v": """
  SELECT a.locationid, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM zones_v a
  JOIN (SELECT locationid, ring, count(*) AS n FROM zones_v GROUP BY locationid, ring) c
    ON a.locationid = c.locationid AND a.ring = c.ring
  JOIN zones_v b
    ON b.locationid = a.locationid AND b.ring = a.ring AND b.seq = (a.seq + 1) % c.n""",
    "station_zone_o": """
  SELECT s.station_id, s.latitude, s.longitude, h.locationid
  FROM stations_v s LEFT JOIN (
    SELECT station_id, min(locationid) AS locationid FROM (
      SELECT s.station_id, e.locationid
      FROM stations_v s JOIN edges_v e
        ON ((e.y1 > s.latitude) <> (e.y2 > s.latitude))
       AND s.longitude < (e.x2 - e.x1) * (s.latitude - e.y1) / (e.y2 - e.y1) + e.x1
      WHERE e.locationid IN (SELECT locationid FROM zones_kept)
      GROUP BY s.station_id, e.locationid
      HAVING count(*) % 2 = 1)
    GROUP BY station_id) h ON s.station_id = h.station_id""",
    "station_hours_o": """
  SELECT station_id, date_trunc('hour', "timestamp") AS "timestamp",
         CAST(sum(ridership) AS BIGINT) AS hourly_ridership
  FROM ridership_typed_o
  WHERE "timestamp" >= TIMESTAMP '2024-01-01 00:00:00'
    AND "timestamp" < TIMESTAMP '2024-02-01 00:00:00'
  GROUP BY station_id, date_trunc('hour', "timestamp")""",
    "ridership_zh_o": """
  SELECT z.locationid, h."timestamp" AS hour_ts,
         CAST(sum(h.hourly_ridership) AS BIGINT) AS hourly_ridership
  FROM station_hours_o h JOIN station_zone_o z ON h.station_id = z.station_id
  WHERE z.locationid IS NOT NULL
  GROUP BY z.locationid, h."timestamp"
""",
    "ridership_text_o": """
  SELECT strftime(ts, '%m/%d/%Y %I:%M:%S %p') AS transit_timestamp,
         CAST(user_id AS VARCHAR) AS station_complex_id,
         'Station ' || CAST(user_id AS VARCHAR) AS station_complex,
         ['Q', 'BX', 'M', 'BK', 'SI'][CAST(user_id % 5 AS INTEGER) + 1] AS borough,
         'A C E' AS routes,
         CASE WHEN event_type = 'purchase' THEN 'omny' ELSE 'metrocard' END AS payment_method,
         CASE WHEN event_id % 101 = 0 THEN 'n/a'
              ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS ridership,
         CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR) AS transfers,
         CAST(CAST(user_id * 91 % 1000 AS DOUBLE) / 100 AS VARCHAR) AS latitude,
         CAST(CAST(user_id * 37 % 1000 AS DOUBLE) / 100 AS VARCHAR) AS longitude,
         'POINT (' || CAST(CAST(user_id * 37 % 1000 AS DOUBLE) / 100 AS VARCHAR) || ' '
           || CAST(CAST(user_id * 91 % 1000 AS DOUBLE) / 100 AS VARCHAR) || ')' AS georeference
  FROM events WHERE event_type IN ('purchase', 'signup')""",
    "combined_o": COMBINED_BODY,
    "split_o": """
  SELECT *, CASE WHEN NOT (dayofmonth < 22) THEN 'test'
                 WHEN bucket < 70 THEN 'train' ELSE 'validation' END AS split,
         CAST(bucket % 5 AS INTEGER) AS fold
  FROM (SELECT *, CAST(CAST(('0x' || substr(md5(concat_ws(':', locationid, year, month,
                    dayofmonth, hour)), 1, 8)) AS BIGINT) % 100 AS INTEGER) AS bucket
        FROM combined_o)""",
    "ridge_o": RIDGE_BODY,
    "pickups_zh_o": """
  SELECT pulocationid AS locationid, date_trunc('hour', pu_time) AS hour_ts,
         CAST(count(pu_time) AS BIGINT) AS pu_hourly,
         CAST(sum(passenger_count) AS BIGINT) AS hourly_passengers
  FROM clean_pickups_o
  GROUP BY pulocationid, date_trunc('hour', pu_time)""",
}

# Dependencies between the views (inlined in this order).
VIEW_ORDER = ["trips_v", "zone_attrs", "zones_kept", "pickups_v", "ridership_v",
              "event_trips_v", "clean_pickups_o", "ridership_typed_o", "stations_v", "zones_v", "edges_v",
              "zones_m", "edges_m", "rings_m", "nesting_m", "parts_m", "station_zone_o", "station_hours_o",
              "ridership_text_o", "pickups_zh_o", "ridership_zh_o", "combined_o",
              "split_o", "ridge_o"]
VIEW_DEPS = {
    "zones_kept": ["zone_attrs"],
    "zones_v": ["zone_attrs"],
    "edges_v": ["zones_v"],
    "zones_m": ["zone_attrs"],
    "edges_m": ["zones_m"],
    "rings_m": ["edges_m"],
    "nesting_m": ["rings_m", "edges_m"],
    "parts_m": ["nesting_m"],
    "station_zone_o": ["stations_v", "edges_v", "zones_kept"],
    "station_hours_o": ["ridership_typed_o"],
    "clean_pickups_o": ["event_trips_v", "zones_kept"],
    "ridership_zh_o": ["station_hours_o", "station_zone_o"],
    "pickups_zh_o": ["clean_pickups_o"],
    "combined_o": ["pickups_zh_o", "ridership_zh_o"],
    "split_o": ["combined_o"],
    "ridge_o": ["split_o"],
}


def with_views(body: str, *names: str) -> str:
    """Prefix `body` with the CTEs it needs (plus their dependencies)."""
    deps = VIEW_DEPS
    need: set[str] = set()

    def add(n: str) -> None:
        for d in deps.get(n, []):
            add(d)
        need.add(n)

    for n in names:
        add(n)
    # what several later steps read is computed once
    once = {"combined_o", "split_o", "ridge_o"}
    ctes = [f"{n} AS {'MATERIALIZED ' if n in once else ''}({VIEWS[n]}\n)"
            for n in VIEW_ORDER if n in need]
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body


def calendar_sql(ts: str) -> str:
    return (f"CAST(year({ts}) AS INTEGER) AS year, CAST(month({ts}) AS INTEGER) AS month, "
            f"CAST(day({ts}) AS INTEGER) AS dayofmonth, "
            f"CAST(dayofweek({ts}) + 1 AS INTEGER) AS dayofweek, "
            f"CAST(hour({ts}) AS INTEGER) AS hour")


# --- rules on trips_v (fixture arguments) ----------------------------------

RULE_SQL = {
    "period": "pu_time >= TIMESTAMP '1996-03-01 00:00:00' AND pu_time < TIMESTAMP '1999-04-01 00:00:00'",
    "area": "pulocationid IN (SELECT locationid FROM zones_kept) "
            "AND dolocationid IN (SELECT locationid FROM zones_kept) "
            "AND pulocationid <= 263 AND dolocationid <= 263",
    "duration": "pu_time <> do_time AND pu_time < do_time",
    "distance": "trip_distance > 0 AND trip_distance <= CAST(45 AS DOUBLE)",
    "tip": "tip_amount >= 0 AND tip_amount < CAST(0.05 AS DOUBLE) * total_amount",
    "fare": "fare_amount >= CAST(1500 AS DOUBLE) AND total_amount >= CAST(1500 AS DOUBLE) "
            "AND fare_amount < CAST(90000 AS DOUBLE)",
    "surcharges": "mta_tax >= 0 AND mta_tax <= CAST(0.07 AS DOUBLE) AND tolls_amount >= 0 "
                  "AND tolls_amount <= CAST(5000 AS DOUBLE) AND extra >= 0",
    "passengers": "passenger_count > 0 AND passenger_count <= 6",
    "categories": "ratecodeid <= 6 AND payment_type <= 6",
}
RULES = list(RULE_SQL)


def _ok(name: str) -> str:
    return f"coalesce(({RULE_SQL[name]}), false)"


ORACLE: dict[str, str] = {}

ORACLE["hourly_pickups"] = with_views(f"""
SELECT pulocationid, {calendar_sql('pu_time')},
       CAST(count(pu_time) AS BIGINT) AS pu_hourly,
       CAST(sum(passenger_count) AS BIGINT) AS hourly_passengers
FROM pickups_v
GROUP BY pulocationid, year, month, dayofmonth, dayofweek, hour""", "pickups_v")

for _r in RULES:
    ORACLE[f"filter_{_r}"] = with_views(
        f"SELECT * FROM trips_v WHERE {RULE_SQL[_r]}", "trips_v", "zones_kept")

ORACLE["clean_trips"] = with_views(
    "SELECT * FROM trips_v WHERE " + " AND ".join(f"({RULE_SQL[r]})" for r in RULES),
    "trips_v", "zones_kept")

ORACLE["attrition_funnel"] = with_views(
    "SELECT 0 AS step, 'start' AS rule, CAST(count(*) AS BIGINT) AS rows_left FROM trips_v\n"
    + "\n".join(
        f"UNION ALL SELECT {i + 1}, '{r}', CAST(count(*) AS BIGINT) FROM trips_v WHERE "
        + " AND ".join(f"({RULE_SQL[x]})" for x in RULES[: i + 1])
        for i, r in enumerate(RULES)),
    "trips_v", "zones_kept")

ORACLE["rule_rejections"] = with_views(
    "SELECT 0 AS step, 'none' AS rule, CAST(NULL AS BIGINT) AS failed_alone, "
    "CAST(count(*) FILTER (WHERE " + " AND ".join(_ok(r) for r in RULES)
    + ") AS BIGINT) AS first_failed FROM trips_v\n"
    + "\n".join(
        f"UNION ALL SELECT {i + 1}, '{r}', "
        f"CAST(count(*) FILTER (WHERE NOT {_ok(r)}) AS BIGINT), "
        f"CAST(count(*) FILTER (WHERE "
        + " AND ".join([_ok(x) for x in RULES[:i]] + [f"NOT {_ok(r)}"])
        + ") AS BIGINT) FROM trips_v"
        for i, r in enumerate(RULES)),
    "trips_v", "zones_kept")


# --- spatial ----------------------------------------------------------------

ORACLE["polygon_edges"] = with_views(
    "SELECT locationid, x1, y1, x2, y2 FROM edges_v", "edges_v")

ORACLE["station_points"] = with_views("""
SELECT station_id, longitude AS lon, latitude AS lat,
       CAST(floor(longitude / 1.0) AS BIGINT) AS tx, CAST(floor(latitude / 1.0) AS BIGINT) AS ty
FROM stations_v""", "stations_v")

POINT_IN_ZONE = """
, pts AS (
  SELECT c_custkey AS point_id, CAST(c_custkey * 37 % 1000 AS DOUBLE) / 100 AS lon,
         CAST(c_custkey * 91 % 1000 AS DOUBLE) / 100 AS lat
  FROM customer),
hits AS (
  SELECT p.point_id, e.locationid
  FROM pts p JOIN {edges} e
    ON ((e.y1 > p.lat) <> (e.y2 > p.lat))
   AND p.lon < (e.x2 - e.x1) * (p.lat - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY p.point_id, e.locationid
  HAVING count(*) % 2 = 1)
SELECT p.point_id, p.lon, p.lat, h.locationid
FROM pts p LEFT JOIN (SELECT point_id, min(locationid) AS locationid FROM hits GROUP BY point_id) h
  ON p.point_id = h.point_id"""

ORACLE["point_in_zone"] = with_views(POINT_IN_ZONE.format(edges="edges_v"), "edges_v")

ORACLE["point_in_multipart_zone"] = with_views(POINT_IN_ZONE.format(edges="edges_m"), "edges_m")

ORACLE["polygon_parts"] = with_views("""
SELECT locationid, ring, CAST(part AS INTEGER) AS part, depth % 2 = 1 AS hole,
       CAST(depth AS INTEGER) AS depth, round(area, 9) AS area
FROM parts_m""", "parts_m")

# written outlines run counter-clockwise, holes clockwise
ORACLE["polygon_wkt_edges"] = with_views("""
SELECT e.locationid,
       round(CASE WHEN (p.area < 0) = (p.depth % 2 = 1) THEN e.x1 ELSE e.x2 END, 9) AS x1,
       round(CASE WHEN (p.area < 0) = (p.depth % 2 = 1) THEN e.y1 ELSE e.y2 END, 9) AS y1,
       round(CASE WHEN (p.area < 0) = (p.depth % 2 = 1) THEN e.x2 ELSE e.x1 END, 9) AS x2,
       round(CASE WHEN (p.area < 0) = (p.depth % 2 = 1) THEN e.y2 ELSE e.y1 END, 9) AS y2
FROM edges_m e JOIN parts_m p ON e.locationid = p.locationid AND e.ring = p.ring""", "edges_m", "parts_m")

ORACLE["multipart_geojson"] = with_views("""
SELECT p.locationid, a.borough, a.zone,
       CASE WHEN max(p.part) OVER (PARTITION BY p.locationid) = 0 THEN 'Polygon'
            ELSE 'MultiPolygon' END AS geometry_type,
       CAST(p.part AS INTEGER) AS part,
       CAST(row_number() OVER (PARTITION BY p.locationid, p.part ORDER BY p.depth % 2, p.ring) - 1
            AS INTEGER) AS place,
       CAST(p.n + 1 AS INTEGER) AS n_points, true AS closed,
       round(CASE WHEN p.depth % 2 = 1 THEN -abs(p.area) ELSE abs(p.area) END, 9) AS area
FROM parts_m p JOIN zone_attrs a ON p.locationid = a.locationid""", "parts_m")

ORACLE["wkt_problems"] = with_views("""
SELECT locationid,
       ['unbalanced', 'not a number', 'not a polygon', 'not closed', 'too few points',
        NULL, NULL, NULL, NULL, 'missing', NULL][CASE WHEN locationid % 11 = 0 THEN 11
                                                  ELSE locationid % 11 END] AS problem,
       CASE locationid % 11 WHEN 0 THEN 1 WHEN 6 THEN 0 WHEN 7 THEN 2 WHEN 8 THEN 0 WHEN 9 THEN 1
            ELSE NULL END AS n_parts
FROM zone_attrs""", "zone_attrs")

ORACLE["station_zone"] = with_views(
    "SELECT station_id, latitude, longitude, locationid FROM station_zone_o", "station_zone_o")

# --- hourly ridership, joins --------------------------------------------------

ORACLE["hourly_station_ridership"] = with_views(f"""
SELECT station_id, "timestamp", hourly_ridership, {calendar_sql('"timestamp"')}
FROM station_hours_o""", "station_hours_o")

ORACLE["hourly_zone_ridership"] = with_views(f"""
SELECT locationid, hourly_ridership, {calendar_sql('hour_ts')}
FROM ridership_zh_o""", "ridership_zh_o")

ORACLE["distinct_stations"] = with_views("""
SELECT DISTINCT CAST(user_id AS VARCHAR) AS station_id,
       CAST(user_id * 91 % 1000 AS DOUBLE) / 100 AS latitude,
       CAST(user_id * 37 % 1000 AS DOUBLE) / 100 AS longitude
FROM events WHERE event_type IN ('purchase', 'signup')""")

ORACLE["station_zone_attrs"] = with_views("""
SELECT s.locationid, s.station_id, s.latitude, s.longitude, z.borough, z.zone
FROM station_zone_o s LEFT JOIN zone_attrs z ON s.locationid = z.locationid""",
    "station_zone_o", "zone_attrs")

ORACLE["ridership_with_zone"] = with_views(f"""
SELECT h.station_id, h."timestamp", h.hourly_ridership, z.locationid,
       {calendar_sql('h."timestamp"')}
FROM station_hours_o h LEFT JOIN station_zone_o z ON h.station_id = z.station_id""",
    "station_hours_o", "station_zone_o")

ORACLE["combined_demand"] = with_views("SELECT * FROM combined_o", "combined_o")

ORACLE["zones_without_ridership"] = with_views("""
SELECT locationid, CAST(sum(pu_hourly) AS BIGINT) AS pickups
FROM pickups_zh_o
WHERE locationid NOT IN (SELECT locationid FROM ridership_zh_o)
GROUP BY locationid""", "pickups_zh_o", "ridership_zh_o")


# --- exploration -------------------------------------------------------------

ORACLE["log_pickups_by_zone"] = with_views("""
SELECT locationid, CAST(sum(pu_hourly) AS BIGINT) AS total_pickups,
       CASE WHEN sum(pu_hourly) > 0 THEN round(ln(sum(pu_hourly)), 9) END AS log_pickups
FROM combined_o GROUP BY locationid""", "combined_o")

ORACLE["log_ridership_by_zone"] = with_views("""
SELECT locationid, CAST(sum(hourly_ridership) AS BIGINT) AS total_ridership,
       CASE WHEN sum(hourly_ridership) > 0 THEN round(ln(sum(hourly_ridership)), 9) END AS log_ridership
FROM combined_o GROUP BY locationid""", "combined_o")

ORACLE["borough_totals"] = with_views("""
SELECT z.borough, CAST(sum(c.pu_hourly) AS BIGINT) AS pickups,
       CAST(sum(c.hourly_ridership) AS BIGINT) AS ridership,
       sum(c.pu_hourly) / (SELECT sum(pu_hourly) FROM combined_o) AS pickup_share
FROM combined_o c LEFT JOIN zone_attrs z ON c.locationid = z.locationid
GROUP BY z.borough""", "combined_o", "zone_attrs")

ORACLE["weekday_hour_profile"] = with_views("""
SELECT dayofweek, hour, CAST(sum(pu_hourly) AS BIGINT) AS pickups,
       CAST(sum(hourly_ridership) AS BIGINT) AS ridership,
       CAST(count(*) AS BIGINT) AS zone_hours, avg(pu_hourly) AS mean_pickups
FROM combined_o GROUP BY dayofweek, hour""", "combined_o")

ORACLE["peak_hour_by_weekday"] = with_views("""
, prof AS (SELECT dayofweek, hour, sum(pu_hourly) AS n FROM combined_o GROUP BY dayofweek, hour),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY dayofweek ORDER BY n DESC, hour) AS rp,
            row_number() OVER (PARTITION BY dayofweek ORDER BY n, hour) AS rt
  FROM prof)
SELECT a.dayofweek, a.hour AS peak_hour, CAST(a.n AS BIGINT) AS peak_pickups,
       b.hour AS trough_hour, CAST(b.n AS BIGINT) AS trough_pickups
FROM ranked a JOIN ranked b ON a.dayofweek = b.dayofweek AND a.rp = 1 AND b.rt = 1""",
    "combined_o")

ORACLE["dataset_shape"] = with_views("""
SELECT 'trips' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, 19 AS n_columns FROM trips_v
UNION ALL SELECT 'ridership', CAST(count(*) AS BIGINT), 11 FROM events
  WHERE event_type IN ('purchase', 'signup')
UNION ALL SELECT 'zones', CAST(count(*) AS BIGINT), 3 FROM zone_attrs""", "trips_v", "zone_attrs")

TRIP_COLUMNS = ["vendorid", "pu_time", "do_time", "passenger_count", "trip_distance",
                "ratecodeid", "store_and_fwd_flag", "pulocationid", "dolocationid",
                "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount",
                "tolls_amount", "improvement_surcharge", "total_amount",
                "congestion_surcharge", "airport_fee"]
_TIMES = {"pu_time", "do_time"}
_NON_NUMERIC = {*_TIMES, "store_and_fwd_flag"}
_INTEGERS = {"vendorid", "passenger_count", "ratecodeid", "pulocationid", "dolocationid",
             "payment_type"}


def _range_sql(c: str) -> str:
    kinds = [("value", "DOUBLE", c not in _NON_NUMERIC), ("int", "BIGINT", c in _INTEGERS),
             ("time", "TIMESTAMP", c in _TIMES)]
    return ", ".join(f"CAST({f'{end}({c})' if has else 'NULL'} AS {t}) AS {end}_{kind}"
                     for kind, t, has in kinds for end in ("min", "max"))


ORACLE["null_profile"] = with_views("\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null, "
    + _range_sql(c) + " FROM trips_v" for c in TRIP_COLUMNS), "trips_v")

RIDERSHIP_TEXT_COLUMNS = ["transit_timestamp", "station_complex_id", "station_complex",
                          "borough", "routes", "payment_method", "ridership", "transfers",
                          "latitude", "longitude", "georeference"]

ORACLE["constant_columns"] = with_views("\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, "
    f"(count({c}) = count(*) AND count(DISTINCT {c}) = 1) AS is_constant FROM ridership_text_o"
    for c in RIDERSHIP_TEXT_COLUMNS), "ridership_text_o")

ORACLE["transfer_subset_check"] = with_views("""
, t AS (SELECT TRY_CAST(transfers AS INTEGER) AS a, TRY_CAST(ridership AS INTEGER) AS b
        FROM ridership_text_o)
SELECT CAST(count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS BIGINT) AS n_checked,
       CAST(count(*) FILTER (WHERE a > b) AS BIGINT) AS n_violations,
       count(*) FILTER (WHERE a > b) = 0 AS holds
FROM t""", "ridership_text_o")

ORACLE["hourly_pickups_sorted"] = ORACLE["hourly_pickups"]

ORACLE["top_zones"] = with_views("""
SELECT locationid, CAST(sum(pu_hourly) AS BIGINT) AS total
FROM combined_o GROUP BY locationid ORDER BY total DESC, locationid LIMIT 10""", "combined_o")


# --- models -----------------------------------------------------------------

ORACLE["train_val_split"] = with_views("""
SELECT locationid, year, month, dayofmonth, hour, bucket, split, fold FROM split_o""",
    "split_o")

ORACLE["ridge_grid_search"] = with_views("""
SELECT CAST(alpha AS DOUBLE) AS alpha, round(mean_mse, 6) AS mean_mse, is_best
FROM ridge_o""", "ridge_o")

ORACLE["ridge_coefficients"] = with_views("""
, c AS (SELECT * FROM ridge_o LIMIT 1)
SELECT 'alpha' AS term, CAST(best_alpha AS DOUBLE) AS value FROM c
UNION ALL SELECT 'intercept', round(intercept, 6) FROM c
UNION ALL SELECT 'hour', round(w1, 6) FROM c
UNION ALL SELECT 'hourly_ridership', round(w2, 6) FROM c""", "ridge_o")

ORACLE["ridge_predictions"] = with_views("""
, c AS (SELECT * FROM ridge_o LIMIT 1)
SELECT s.locationid, s.year, s.month, s.dayofmonth, s.hour, s.pu_hourly,
       round(c.intercept + c.w1 * s.hour + c.w2 * s.hourly_ridership, 6) AS prediction
FROM split_o s JOIN c ON true WHERE s.split = 'validation'""", "ridge_o")

ORACLE["regression_metrics"] = with_views("""
, c AS (SELECT * FROM ridge_o LIMIT 1),
p AS (SELECT s.split, CAST(s.pu_hourly AS DOUBLE) AS y,
             c.intercept + c.w1 * s.hour + c.w2 * s.hourly_ridership AS yhat
      FROM split_o s JOIN c ON true),
mu AS (SELECT split, avg(y) AS ybar FROM p GROUP BY split)
SELECT p.split, CAST(count(*) AS BIGINT) AS n,
       round(avg((p.y - p.yhat) * (p.y - p.yhat)), 6) AS mse,
       round(CASE WHEN sum((p.y - mu.ybar) * (p.y - mu.ybar)) > 0 THEN
         1 - sum((p.y - p.yhat) * (p.y - p.yhat)) / sum((p.y - mu.ybar) * (p.y - mu.ybar))
       END, 6) AS r2
FROM p JOIN mu ON p.split = mu.split GROUP BY p.split""", "ridge_o")


def _ridge_full_sql() -> str:
    """Normal equations of the centred features (alpha 1) by Gauss-Jordan
    steps; column 5 is the label."""
    names = ["locationid", "dayofmonth", "dayofweek", "hour", "hourly_ridership"]
    p = len(names)
    values = " UNION ALL ".join(
        f"SELECT id, {i} AS i, CAST({c} AS DOUBLE) AS v FROM tr"
        for i, c in enumerate([*names, "pu_hourly"]))
    steps = "".join(f"""
, m{k + 1} AS MATERIALIZED (
  SELECT a.i, a.j, CASE WHEN a.i = {k} THEN a.v / p.v ELSE a.v - c.v * r.v / p.v END AS v
  FROM m{k} a JOIN m{k} c ON c.i = a.i AND c.j = {k} JOIN m{k} r ON r.i = {k} AND r.j = a.j
  JOIN m{k} p ON p.i = {k} AND p.j = {k})""" for k in range(p))
    terms = "".join(f" UNION ALL SELECT '{c}', round(v, 6) FROM w WHERE i = {i}"
                    for i, c in enumerate(names))
    return f"""
, tr AS MATERIALIZED (SELECT *, row_number() OVER () AS id FROM split_o WHERE split = 'train')
, vals AS MATERIALIZED ({values})
, mu AS MATERIALIZED (SELECT i, avg(v) AS m FROM vals GROUP BY i)
, c AS MATERIALIZED (SELECT id, vals.i, v - m AS v FROM vals JOIN mu ON vals.i = mu.i)
, m0 AS MATERIALIZED (
  SELECT a.i, b.i AS j, sum(a.v * b.v) + CASE WHEN a.i = b.i THEN 1 ELSE 0 END AS v
  FROM c a JOIN c b ON a.id = b.id WHERE a.i < {p} GROUP BY a.i, b.i){steps}
, w AS (SELECT i, v FROM m{p} WHERE j = {p})
SELECT 'alpha' AS term, CAST(1 AS DOUBLE) AS value
UNION ALL SELECT 'intercept', round((SELECT m FROM mu WHERE i = {p})
  - (SELECT sum(w.v * mu.m) FROM w JOIN mu ON w.i = mu.i), 6){terms}"""


ORACLE["ridge_full"] = with_views(_ridge_full_sql(), "split_o")


def _split_sql(rows: str) -> str:
    """Per group g and node the threshold, halfway between two values, that
    leaves the smallest squared error."""
    return f"""(
  SELECT g, node, f, th FROM (
    SELECT *, row_number() OVER (PARTITION BY g, node ORDER BY score DESC, f DESC, th) AS rn FROM (
      SELECT g, node, f, (x + nx) / 2 AS th,
             ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) AS score FROM (
        SELECT g, node, f, x, lead(x) OVER w AS nx, sum(n) OVER w AS ln, sum(s) OVER w AS ls,
               sum(n) OVER p AS tn, sum(s) OVER p AS ts FROM (
          SELECT g, node, f, x, count(*) AS n, sum(y) AS s FROM (
            SELECT g, node, 'hour' AS f, h AS x, y FROM {rows} WHERE fits
            UNION ALL SELECT g, node, 'dayofweek', d, y FROM {rows} WHERE fits)
          GROUP BY g, node, f, x)
        WINDOW p AS (PARTITION BY g, node, f), w AS (PARTITION BY g, node, f ORDER BY x))
      WHERE nx IS NOT NULL))
  WHERE rn = 1)"""


# A tree of depth 2 per group: g = -1 learns from all training rows, g = 0..4
# from those outside fold g. p1, p2: the prediction at depth 1 and 2.
_SIDE = "CASE WHEN b.f IS NULL THEN 0 WHEN CASE b.f WHEN 'hour' THEN h ELSE d END <= b.th THEN 1 ELSE 2 END"
_KEEP = "locationid, year, month, dayofmonth, hour, split, fold, fits, h, d, y"
TREE_BODY = f"""
, t0 AS MATERIALIZED (
  SELECT gs.g, 0 AS node, locationid, year, month, dayofmonth, hour, split, fold,
         split = 'train' AND fold <> gs.g AS fits, CAST(hour AS DOUBLE) AS h,
         CAST(dayofweek AS DOUBLE) AS d, CAST(pu_hourly AS DOUBLE) AS y
  FROM split_o JOIN (SELECT unnest([-1, 0, 1, 2, 3, 4]) AS g) gs ON gs.g = -1 OR split = 'train')
, b0 AS MATERIALIZED {_split_sql("t0")}
, t1 AS MATERIALIZED (SELECT t.g, {_SIDE} AS node, {_KEEP}
  FROM t0 t LEFT JOIN b0 b ON t.g = b.g AND t.node = b.node)
, b1 AS MATERIALIZED {_split_sql("t1")}
, t2 AS MATERIALIZED (SELECT t.g, t.node AS n1, 3 * t.node + {_SIDE} AS node, {_KEEP}
  FROM t1 t LEFT JOIN b1 b ON t.g = b.g AND t.node = b.node)
, l1 AS MATERIALIZED (SELECT g, node, avg(y) AS p1 FROM t1 WHERE fits GROUP BY g, node)
, l2 AS MATERIALIZED (SELECT g, node, avg(y) AS p2 FROM t2 WHERE fits GROUP BY g, node)
, scored AS (SELECT t2.*, p1, p2 FROM t2 JOIN l1 ON t2.g = l1.g AND t2.n1 = l1.node
             JOIN l2 ON t2.g = l2.g AND t2.node = l2.node)"""

ORACLE["tree_predictions"] = with_views(TREE_BODY + """
SELECT locationid, year, month, dayofmonth, hour, split, round(p1, 6) AS prediction
FROM scored WHERE g = -1""", "split_o")

ORACLE["tree_training_error"] = with_views(TREE_BODY + """
, e AS (SELECT (y - p1) * (y - p1) AS e1, (y - p2) * (y - p2) AS e2 FROM scored
        WHERE g = -1 AND split = 'train')
SELECT 1 AS max_depth, CAST(count(*) AS BIGINT) AS n, round(avg(e1), 6) AS mse FROM e
UNION ALL SELECT 2, CAST(count(*) AS BIGINT), round(avg(e2), 6) FROM e""", "split_o")

ORACLE["tree_depth_search"] = with_views(TREE_BODY + """
, e AS (SELECT g, avg((y - p1) * (y - p1)) AS e1, avg((y - p2) * (y - p2)) AS e2
        FROM scored WHERE g = fold AND split = 'train' GROUP BY g)
SELECT 1 AS max_depth, 1 AS min_instances, round(avg(e1), 6) AS mean_mse FROM e
UNION ALL SELECT 2, 1, round(avg(e2), 6) FROM e""", "split_o")


# --- trees grown in SQL: any depth, three criteria -----------------------------

def _grown(rows: str, features: list[str], depth: int) -> str:
    """CTEs that grow a tree per group g over `rows` (g, criterion, fits, y and
    the features), level by level, to `depth`. The last one, grown, has each
    row's path: a list of (n, p) of the nodes on its way."""
    p = len(features)
    x = ", ".join(f"CAST({c} AS DOUBLE)" for c in features)
    out = [f"""
, t0 AS MATERIALIZED (SELECT *, [{x}] AS x, CAST(1 AS BIGINT) AS node,
    CAST([] AS STRUCT(n BIGINT, p DOUBLE)[]) AS path FROM {rows})"""]
    for k in range(depth + 1):
        out.append(f"""
, s{k} AS MATERIALIZED (
  SELECT g, node, count(*) AS n, min(y) < max(y) AS impure,
         CASE WHEN any_value(criterion) = 'absolute_error' THEN median(y)
              ELSE sum(y) / CAST(count(*) AS DOUBLE) END AS p
  FROM t{k} WHERE fits AND node IS NOT NULL GROUP BY g, node)""")
        if k == depth:
            out.append(f"""
, grown AS (SELECT t.* EXCLUDE (path), CASE WHEN s.n IS NULL THEN path
      ELSE list_append(path, {{'n': s.n, 'p': s.p}}) END AS path
  FROM t{k} t LEFT JOIN s{k} s ON t.g = s.g AND t.node = s.node)""")
            break
        out.append(f"""
, c{k} AS MATERIALIZED (
  SELECT g, criterion, node, f, x[f + 1] AS v, y, count(*) AS n
  FROM (SELECT t.g, criterion, t.node, x, y, unnest(range({p})) AS f
        FROM t{k} t JOIN s{k} s ON t.g = s.g AND t.node = s.node WHERE fits AND impure)
  GROUP BY g, criterion, node, f, x[f + 1], y)
, m{k} AS (
  SELECT g, node, f, v, nv, CASE criterion
      WHEN 'friedman_mse' THEN -(ln * (tn - ln) / tn * (ls / ln - (ts - ls) / (tn - ln)) * (ls / ln - (ts - ls) / (tn - ln)))
      ELSE -(ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln)) END AS loss
  FROM (
    SELECT g, criterion, node, f, v, lead(v) OVER w AS nv, CAST(sum(n) OVER w AS DOUBLE) AS ln,
           sum(s) OVER w AS ls, CAST(sum(n) OVER q AS DOUBLE) AS tn, sum(s) OVER q AS ts
    FROM (SELECT g, criterion, node, f, v, sum(n) AS n, sum(n * y) AS s FROM c{k}
          WHERE criterion <> 'absolute_error' GROUP BY g, criterion, node, f, v)
    WINDOW q AS (PARTITION BY g, node, f), w AS (PARTITION BY g, node, f ORDER BY v))
  WHERE nv IS NOT NULL)
, d{k} AS (
  SELECT g, node, f, v, sum(n) OVER (PARTITION BY g, node, f, y ORDER BY v) AS c, y, total
  FROM (
    SELECT a.g, a.node, a.f, a.v, b.y, b.total, coalesce(c.n, 0) AS n
    FROM (SELECT DISTINCT g, node, f, v FROM c{k} WHERE criterion = 'absolute_error') a
    JOIN (SELECT g, node, y, sum(n) AS total FROM c{k} WHERE criterion = 'absolute_error' AND f = 0
          GROUP BY g, node, y) b ON a.g = b.g AND a.node = b.node
    LEFT JOIN c{k} c ON c.g = a.g AND c.node = a.node AND c.f = a.f AND c.v = a.v AND c.y = b.y))
, a{k} AS (
  SELECT g, node, f, v, lead(v) OVER (PARTITION BY g, node, f ORDER BY v) AS nv, loss
  FROM (
    SELECT g, node, f, v, sum(width * (least(lo, ln - lo) + least(hi - lo, (tn - ln) - (hi - lo)))) AS loss
    FROM (
      SELECT g, node, f, v, lead(y) OVER w - y AS width, sum(c) OVER w AS lo, sum(total) OVER w AS hi,
             sum(c) OVER q AS ln, sum(total) OVER q AS tn
      FROM d{k} WINDOW q AS (PARTITION BY g, node, f, v), w AS (PARTITION BY g, node, f, v ORDER BY y))
    GROUP BY g, node, f, v))
, b{k} AS MATERIALIZED (
  SELECT g, node, f, th FROM (
    SELECT *, row_number() OVER (PARTITION BY g, node ORDER BY loss, f, th) AS rn
    FROM (SELECT g, node, f, CASE WHEN (v + nv) / 2 >= nv THEN v ELSE (v + nv) / 2 END AS th, loss
          FROM (SELECT * FROM m{k} UNION ALL SELECT * FROM a{k} WHERE nv IS NOT NULL)))
  WHERE rn = 1)
, t{k + 1} AS MATERIALIZED (
  SELECT t.* EXCLUDE (node, path),
         CASE WHEN b.f IS NOT NULL THEN 2 * t.node + CASE WHEN t.x[b.f + 1] > b.th THEN 1 ELSE 0 END END AS node,
         CASE WHEN s.n IS NULL THEN path ELSE list_append(path, {{'n': s.n, 'p': s.p}}) END AS path
  FROM t{k} t LEFT JOIN s{k} s ON t.g = s.g AND t.node = s.node
  LEFT JOIN b{k} b ON t.g = b.g AND t.node = b.node)""")
    return "".join(out)


_TREE_FEATURES = ["locationid", "dayofmonth", "dayofweek", "hour", "hourly_ridership"]
# More levels than the tree over all features has on the test tables; the tree
# tests assert that it is finished before.
TREE_LEVELS = 40

ORACLE["tree_metrics"] = with_views("""
, fitted AS MATERIALIZED (
  SELECT 0 AS g, 'squared_error' AS criterion, split, split = 'train' AS fits, CAST(pu_hourly AS DOUBLE) AS y,
         locationid, dayofmonth, dayofweek, hour, hourly_ridership FROM split_o)"""
    + _grown("fitted", _TREE_FEATURES, TREE_LEVELS) + """
, scored AS (SELECT split, y, path[len(path)].p AS yhat FROM grown),
mu AS (SELECT split, avg(y) AS ybar FROM scored GROUP BY split)
SELECT s.split, CAST(count(*) AS BIGINT) AS n, round(avg((y - yhat) * (y - yhat)), 6) AS mse,
       round(CASE WHEN sum((y - ybar) * (y - ybar)) > 0 THEN
         1 - sum((y - yhat) * (y - yhat)) / sum((y - ybar) * (y - ybar)) END, 6) AS r2
FROM scored s JOIN mu ON s.split = mu.split GROUP BY s.split""", "split_o")

ORACLE["tree_grid_search"] = with_views("""
, fitted AS MATERIALIZED (
  SELECT criterion || fold_no AS g, criterion, fold <> fold_no AS fits, fold, CAST(pu_hourly AS DOUBLE) AS y,
         locationid, dayofmonth, dayofweek, hour, hourly_ridership
  FROM split_o, (SELECT unnest(['squared_error', 'absolute_error', 'friedman_mse']) AS criterion) cs,
       (SELECT unnest(range(5)) AS fold_no) fs
  WHERE split = 'train')"""
    + _grown("fitted", _TREE_FEATURES, 4) + """
, settings AS (SELECT d, m FROM (SELECT unnest(range(1, 5)) AS d), (SELECT unnest(range(2, 10)) AS m)),
own AS (SELECT g, criterion, y, path FROM grown WHERE NOT fits),
scored AS (
  SELECT g, criterion, d, m, y, path[coalesce(
      list_min([i + 1 for i in range(len(path)) if i = d or path[i + 1].n < m]), len(path))].p AS yhat
  FROM own, settings),
per AS (SELECT g, criterion, d, m, avg((y - yhat) * (y - yhat)) AS mse FROM scored GROUP BY g, criterion, d, m)
SELECT criterion, CAST(d AS INTEGER) AS max_depth, CAST(m AS INTEGER) AS min_samples_split,
       round(avg(mse), 6) AS mean_mse
FROM per GROUP BY criterion, d, m""", "split_o")

# the repeated feature shares the coefficient of the one it repeats: together
# they bear half the penalty
ORACLE["ridge_qr"] = with_views("""
, tr AS (SELECT CAST(hour AS DOUBLE) AS h, CAST(hourly_ridership AS DOUBLE) AS r, CAST(pu_hourly AS DOUBLE) AS y
         FROM split_o WHERE split = 'train'),
mu AS (SELECT avg(h) AS mh, avg(r) AS mr, avg(y) AS my FROM tr),
g AS (SELECT sum((h - mh) * (h - mh)) AS hh, sum((h - mh) * (r - mr)) AS hr, sum((r - mr) * (r - mr)) AS rr,
             sum((h - mh) * (y - my)) AS hy, sum((r - mr) * (y - my)) AS ry FROM tr, mu),
w AS (
  SELECT alpha, (hy * (rr + alpha) - ry * hr) / ((hh + alpha / 2) * (rr + alpha) - hr * hr) AS wh,
         (ry * (hh + alpha / 2) - hy * hr) / ((hh + alpha / 2) * (rr + alpha) - hr * hr) AS wr
  FROM g, (SELECT unnest([CAST(0 AS DOUBLE), 1, 15]) AS alpha) a)
SELECT alpha, 'intercept' AS term, round(my - wh * mh - wr * mr, 6) AS value FROM w, mu
UNION ALL SELECT alpha, 'hour', round(wh / 2, 6) FROM w
UNION ALL SELECT alpha, 'hour_again', round(wh / 2, 6) FROM w
UNION ALL SELECT alpha, 'hourly_ridership', round(wr, 6) FROM w
UNION ALL SELECT alpha, 'always', CAST(0 AS DOUBLE) FROM w""", "split_o")

ORACLE["ridge_search_qr"] = ORACLE["ridge_grid_search"]


# --- sources, sinks, column work ------------------------------------------------

_PERIOD = RULE_SQL["period"]
_LANDING_NAMES = {"vendorid": "vendorid", "pu_time": "tpep_pickup_datetime",
                  "do_time": "tpep_dropoff_datetime"}
_LANDING_SELECT = ", ".join(f"{c} AS {_LANDING_NAMES.get(c, c)}" for c in TRIP_COLUMNS)

ORACLE["scan_parquet"] = "SELECT * FROM events"

_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                  "o_orderpriority"]

ORACLE["schema_template"] = "\nUNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, CASE typeof(min({c})) WHEN 'VARCHAR' "
    f"THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' "
    f"ELSE lower(typeof(min({c}))) END AS type_name, CAST(count({c}) AS BIGINT) AS n_values "
    "FROM orders" for i, c in enumerate(_ORDER_COLUMNS))

ORACLE["parquet_create"] = with_views("SELECT * FROM trips_v", "trips_v")

ORACLE["zone_layer"] = with_views("""
SELECT v.locationid, v.ring, v.seq, v.x, v.y, a.borough, a.zone
FROM zones_v v JOIN zone_attrs a ON v.locationid = a.locationid
WHERE v.locationid IN (SELECT locationid FROM zones_kept)""", "zones_v", "zones_kept")

ORACLE["station_layer"] = ORACLE["station_zone"]

ORACLE["month_manifest"] = with_views(f"""
, b AS (SELECT min(pu_time) AS lo, max(pu_time) AS hi FROM trips_v WHERE {_PERIOD}),
m AS (SELECT unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi),
                                    INTERVAL 1 MONTH)) AS m FROM b)
SELECT CAST(m AS DATE) AS month_start, strftime(m, '%Y-%m') AS month,
       'landing/month=' || strftime(m, '%Y-%m') AS path FROM m""", "trips_v")

ORACLE["scan_multi_month"] = with_views(
    "SELECT " + ", ".join(c for c in TRIP_COLUMNS if c != "airport_fee")
    + ", CASE WHEN strftime(pu_time, '%Y-%m') = '1998-06' THEN NULL ELSE airport_fee END"
      " AS airport_fee, strftime(pu_time, '%Y-%m') AS source_month"
    + f" FROM trips_v WHERE {_PERIOD}", "trips_v")

ORACLE["parquet_partition_roundtrip"] = with_views(
    "SELECT *, strftime(pu_time, '%Y-%m') AS source_month FROM trips_v", "trips_v")

ORACLE["year_split"] = with_views(f"""
SELECT * FROM (
  SELECT pulocationid, {calendar_sql('pu_time')},
         CAST(count(pu_time) AS BIGINT) AS pu_hourly,
         CAST(sum(passenger_count) AS BIGINT) AS hourly_passengers
  FROM trips_v WHERE """ + " AND ".join(f"({RULE_SQL[r]})" for r in RULES) + """
  GROUP BY pulocationid, year, month, dayofmonth, dayofweek, hour)
WHERE year = 1997""", "trips_v", "zones_kept")

_BOROUGH_NAME = ("CASE user_id % 5 WHEN 0 THEN 'Queens' WHEN 1 THEN 'Bronx' "
                 "WHEN 2 THEN 'Manhattan' WHEN 3 THEN 'Brooklyn' ELSE 'SI' END")
_RIDER_EVENTS = "FROM events WHERE event_type IN ('purchase', 'signup')"

ORACLE["csv_strings_cast"] = f"""
SELECT date_trunc('second', ts) AS "timestamp", CAST(user_id AS VARCHAR) AS station_id,
       {_BOROUGH_NAME} AS borough,
       CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(floor(value) AS INTEGER) END AS ridership,
       CAST(user_id * 91 % 1000 AS DOUBLE) / 100 AS latitude,
       CAST(user_id * 37 % 1000 AS DOUBLE) / 100 AS longitude
{_RIDER_EVENTS}"""

ORACLE["csv_typed_roundtrip"] = with_views(f"""
SELECT h.station_id, h."timestamp", h.hourly_ridership,
       {calendar_sql('h."timestamp"')}, z.locationid
FROM station_hours_o h LEFT JOIN station_zone_o z ON h.station_id = z.station_id""",
    "station_hours_o", "station_zone_o")

ORACLE["zone_geojson"] = with_views("""
SELECT z.locationid, a.borough, a.zone, 'Feature' AS feature_type, 'Polygon' AS geometry_type,
       1 AS n_rings, CAST(count(*) + 1 AS INTEGER) AS n_points,
       round(sum(z.x) + min(z.x) FILTER (WHERE z.seq = 0), 9) AS x_sum,
       round(sum(z.y) + min(z.y) FILTER (WHERE z.seq = 0), 9) AS y_sum
FROM zones_v z JOIN zone_attrs a ON z.locationid = a.locationid
WHERE z.locationid IN (SELECT locationid FROM zones_kept)
GROUP BY z.locationid, a.borough, a.zone""", "zones_v", "zones_kept")

ORACLE["lowercase_columns"] = with_views(f"SELECT {_LANDING_SELECT} FROM trips_v", "trips_v")

ORACLE["drop_columns"] = with_views(
    "SELECT passenger_count, pulocationid, dolocationid FROM trips_v", "trips_v")

ORACLE["keep_columns"] = f"""
SELECT CAST(user_id AS VARCHAR) AS station_id,
       CAST(user_id * 91 % 1000 AS DOUBLE) / 100 AS latitude,
       CAST(user_id * 37 % 1000 AS DOUBLE) / 100 AS longitude
{_RIDER_EVENTS}"""

ORACLE["rename_columns"] = with_views("SELECT * FROM trips_v", "trips_v")

ORACLE["cast_to_schema"] = with_views(
    "SELECT " + ", ".join(f"{c} AS {_LANDING_NAMES.get(c, c)}" for c in TRIP_COLUMNS
                          if c != "airport_fee")
    + ", CAST(NULL AS DOUBLE) AS airport_fee FROM trips_v", "trips_v")

ORACLE["time_features"] = with_views(
    f"SELECT pulocationid, pu_time, passenger_count, {calendar_sql('pu_time')} FROM pickups_v",
    "pickups_v")

ORACLE["parse_timestamp"] = f"""
SELECT CAST(user_id AS VARCHAR) AS station_complex_id,
       date_trunc('second', ts) AS transit_timestamp
{_RIDER_EVENTS}"""

ORACLE["recode_borough"] = f"""
SELECT CAST(user_id AS VARCHAR) AS station_complex_id, {_BOROUGH_NAME} AS borough
{_RIDER_EVENTS}"""


def _lcc_inverse_sql() -> str:
    from zonecast.functions.geometry import NY_LONG_ISLAND_FTUS as P

    # published parameters: GRS 1980, parallels 41 deg 02' and 40 deg 40', origin
    # 40 deg 10' N 74 deg W, false easting 300000 m, US survey feet
    e = "sqrt(2 / 298.257222101e0 - 1 / (298.257222101e0 * 298.257222101e0))"
    m = "cos({0}) / sqrt(1 - ee * ee * sin({0}) * sin({0}))"
    t = "tan(pi() / 4 - {0} / 2) / pow((1 - ee * sin({0})) / (1 + ee * sin({0})), ee / 2)"
    steps = [f"""
i0 AS (SELECT locationid, ring, seq, t, lon, pi() / 2 - 2 * atan(t) AS phi FROM q)"""]
    for k in range(1, P.iterations + 1):
        steps.append(f"""
i{k} AS (SELECT locationid, ring, seq, t, lon,
        pi() / 2 - 2 * atan(t * pow((1 - ee * sin(phi)) / (1 + ee * sin(phi)),
                                    ee / 2)) AS phi
      FROM i{k - 1}, k1)""")
    return f"""
, k0 AS (SELECT {e} AS ee, radians(41e0 + 2e0 / 60) AS f1, radians(40e0 + 40e0 / 60) AS f2,
                radians(40e0 + 10e0 / 60) AS f0, 1200e0 / 3937e0 AS ft),
km AS (SELECT *, {m.format("f1")} AS m1, {m.format("f2")} AS m2, {t.format("f1")} AS t1,
              {t.format("f2")} AS t2, {t.format("f0")} AS t0 FROM k0),
kn AS (SELECT *, (ln(m1) - ln(m2)) / (ln(t1) - ln(t2)) AS n FROM km),
k1 AS (SELECT *, 6378137e0 * m1 / (n * pow(t1, n)) AS af,
              6378137e0 * m1 / (n * pow(t1, n)) * pow(t0, n) AS rho0 FROM kn),
v AS (SELECT locationid, ring, seq, 913000e0 + x * 15000e0 AS xf,
               120000e0 + y * 15000e0 AS yf FROM zones_v),
p AS (SELECT locationid, ring, seq, xf * ft - 300000e0 AS dx, rho0 - yf * ft AS dy, n, af FROM v, k1),
q AS (SELECT locationid, ring, seq, pow(sqrt(dx * dx + dy * dy) / af, 1 / n) AS t,
             degrees(atan2(dx, dy) / n) - 74e0 AS lon FROM p),""" + ",".join(
        steps) + f"""
SELECT locationid, ring, seq, round(lon, 9) AS lon, round(degrees(phi), 9) AS lat
FROM i{P.iterations}"""


ORACLE["reproject_vertices"] = with_views(_lcc_inverse_sql(), "zones_v")

ORACLE["filter_time_range"] = with_views("""
SELECT * FROM ridership_v
WHERE "timestamp" >= TIMESTAMP '2024-01-08 00:00:00'
  AND "timestamp" < TIMESTAMP '2024-01-15 00:00:00'""", "ridership_v")

ORACLE["filter_regex"] = with_views(
    "SELECT * FROM zone_attrs WHERE regexp_matches(borough, 'AFRICA|AMERICA|ASIA|EUROPE')",
    "zone_attrs")

ORACLE["filter_exclude"] = with_views(
    "SELECT * FROM zone_attrs WHERE borough IS NULL OR borough NOT IN ('MIDDLE EAST')",
    "zone_attrs")


_DAMAGED = """
WITH feed AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CASE WHEN event_id % 109 = 0 THEN '13/45/2024 01:00:00 AM'
              ELSE strftime(ts, '%m/%d/%Y %I:%M:%S %p') END AS transit_timestamp,
         CASE WHEN event_id % 101 = 0 THEN 'n/a' WHEN event_id % 103 = 0 THEN '3000000000'
              WHEN event_id % 107 = 0 THEN '12.7' WHEN event_id % 127 = 0 THEN ' '
              ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS ridership,
         CASE WHEN event_id % 113 = 0 THEN 'north'
              ELSE CAST(CAST(user_id * 91 % 1000 AS DOUBLE) / 100 AS VARCHAR) END AS latitude
  FROM events WHERE event_type IN ('purchase', 'signup')),
lost AS (
  SELECT event_id, 'transit_timestamp' AS column_name, transit_timestamp AS value, 'timestamp_ntz' AS target,
         'not a timestamp' AS reason FROM feed WHERE transit_timestamp LIKE '13/%'
  UNION ALL
  SELECT event_id, 'ridership', ridership, 'int', CASE ridership WHEN 'n/a' THEN 'not a number'
         WHEN '3000000000' THEN 'out of range' ELSE 'fraction lost' END
  FROM feed WHERE ridership IN ('n/a', '3000000000', '12.7')
  UNION ALL
  SELECT event_id, 'latitude', latitude, 'double', 'not a number' FROM feed WHERE latitude = 'north')
"""

ORACLE["rescued_values"] = _DAMAGED + "SELECT * FROM lost"

ORACLE["cast_problem_counts"] = _DAMAGED + """
SELECT l.column_name, reason, CAST(count(*) AS BIGINT) AS n,
       CASE l.column_name
         WHEN 'transit_timestamp' THEN (SELECT count(*) FROM feed WHERE transit_timestamp LIKE '13/%')
         WHEN 'ridership' THEN (SELECT count(*) FROM feed WHERE ridership IN ('n/a', '3000000000', ' '))
         ELSE (SELECT count(*) FROM feed WHERE latitude = 'north') END AS n_null
FROM lost l GROUP BY l.column_name, reason"""

ORACLE["csv_corrupt_records"] = _DAMAGED + """
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(NULL AS INTEGER) AS ridership, latitude,
       event_id || ',' || ridership || ',' || latitude AS line
FROM feed WHERE ridership IN ('n/a', '3000000000', '12.7')"""

ORACLE["combined_from_clustered"] = ORACLE["combined_demand"]

ORACLE["month_commits"] = with_views("""
, t AS (SELECT strftime(pu_time, '%Y-%m') AS month, coalesce(passenger_count, 0) <= 6 AS stays FROM trips_v)
SELECT month, CAST(count(*) FILTER (WHERE month <> '1998-02' OR stays) AS BIGINT) AS n_rows,
       CAST(CASE WHEN month = '1998-02' AND bool_or(NOT stays) THEN 2 ELSE 1 END AS BIGINT) AS number,
       CAST(CASE WHEN month = '1998-02' AND bool_or(NOT stays) THEN 2 ELSE 1 END AS BIGINT) AS n_commits
FROM t GROUP BY month""", "trips_v")

ORACLE["read_committed_months"] = with_views("""
SELECT *, strftime(pu_time, '%Y-%m') AS source_month FROM trips_v
WHERE strftime(pu_time, '%Y-%m') <> '1998-02' OR coalesce(passenger_count, 0) <= 6""", "trips_v")

_PROFILED = [("pu_time", "epoch_us(pu_time) / 1e6"), ("passenger_count", "passenger_count"),
             ("trip_distance", "trip_distance"), ("total_amount", "total_amount"), ("ratecodeid", "ratecodeid"),
             ("pulocationid", "pulocationid"), ("store_and_fwd_flag", "CAST(store_and_fwd_flag AS INTEGER)")]

ORACLE["merged_profile"] = with_views("\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) AS BIGINT) AS n, CAST(count(*) - count({c}) AS BIGINT) AS n_null, "
    f"round(CAST(min({x}) AS DOUBLE), 6) AS low, round(CAST(max({x}) AS DOUBLE), 6) AS high, "
    "true AS distinct_within_error, true AS median_within_error FROM trips_v" for c, x in _PROFILED), "trips_v")


def all_oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
