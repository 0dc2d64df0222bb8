"""The paths taken when a broadcast size check fails: every explicit check is
forced to fail and Spark's own broadcast thresholds are off, so all joins are
shuffle joins. Results must equal the oracle, and no plan may broadcast but
the crowded places of the spatial join, which are 1,000 at most."""

import pytest

import __spark_entry__ as E
from tests.test_registry import TABLES, _digest

NAMES = ["clean_trips", "filter_area", "attrition_funnel", "rule_rejections", "point_in_zone",
         "station_zone", "hourly_zone_ridership", "combined_demand", "ridership_with_zone",
         "station_zone_attrs", "borough_totals", "zones_without_ridership"]

@pytest.fixture()
def no_broadcast(spark, monkeypatch):
    from zonecast.operators import quadtree
    from zonecast.plans import strategy

    monkeypatch.setattr(strategy, "has_at_most", lambda df, n: False)
    monkeypatch.setattr(quadtree, "BROADCAST_LEAVES", -1)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)

@pytest.fixture(scope="module")
def duck(sf_small):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con

@pytest.mark.parametrize("name", NAMES)
def test_shuffle_fallback_matches_oracle(spark, sf_small, duck, no_broadcast, name):
    df = E.queries()[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("== Final Plan ==") if "== Final Plan ==" in plan else 0:
                plan.index("== Initial Plan ==") if "== Initial Plan ==" in plan else None]
    assert plan.count("BroadcastExchange") <= (1 if name == "point_in_zone" else 0)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)
