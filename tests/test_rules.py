"""F1-F16: rule boundaries and the one-pass funnel / rejection report."""

import datetime as dt


from zonecast.operators import rules
from zonecast.plans.demand import curated_zones
from zonecast.plans.fixture_args import FIXTURE_RULES
from zonecast.sources import fixtures as fx

SCHEMA = ("pu_time timestamp_ntz, do_time timestamp_ntz, pulocationid bigint, "
          "dolocationid bigint, trip_distance double, tip_amount double, total_amount double, "
          "fare_amount double, mta_tax double, tolls_amount double, extra double, "
          "passenger_count int, ratecodeid int, payment_type int, tag string")

T0 = dt.datetime(2022, 9, 1, 8, 0)
T1 = dt.datetime(2022, 9, 1, 8, 20)
GOOD = dict(pu_time=T0, do_time=T1, pulocationid=1, dolocationid=2, trip_distance=3.0,
            tip_amount=1.0, total_amount=20.0, fare_amount=15.0, mta_tax=0.5,
            tolls_amount=0.0, extra=0.0, passenger_count=1, ratecodeid=1, payment_type=1)


def _trip(tag, **kw):
    d = dict(GOOD, **kw)
    return tuple(d[k] for k in GOOD) + (tag,)


CASES = {
    "good": ({}, True),
    "null_passenger": ({"passenger_count": None}, False),
    "equal_times": ({"do_time": T0}, False),
    "negative_tip": ({"tip_amount": -0.01}, False),
    "tip_equals_total": ({"tip_amount": 20.0}, False),
    "fare_at_min": ({"fare_amount": 2.5}, True),
    "fare_at_max": ({"fare_amount": 500.0}, False),
    "distance_at_max": ({"trip_distance": 50.0}, True),
    "distance_zero": ({"trip_distance": 0.0}, False),
    "passengers_7": ({"passenger_count": 7}, False),
    "tax_over": ({"mta_tax": 0.51}, False),
    "extra_negative": ({"extra": -0.5}, False),
    "category_7": ({"payment_type": 7}, False),
    "before_period": ({"pu_time": dt.datetime(2022, 7, 31, 23, 59), "do_time": T1}, False),
    "period_end_excluded": ({"pu_time": dt.datetime(2023, 4, 1), "do_time": dt.datetime(2023, 4, 1, 1)}, False),
    "zone_not_kept": ({"dolocationid": 5}, False),
    "zone_over_bound": ({"pulocationid": 264}, False),
}


def _frames(spark):
    trips = spark.createDataFrame([_trip(k, **kw) for k, (kw, _) in CASES.items()], SCHEMA)
    zones = spark.createDataFrame([(1,), (2,), (3,), (264,)], "locationid bigint")
    return trips, zones


def test_boundaries(spark):
    trips, zones = _frames(spark)
    kept = {r.tag for r in rules.clean_trips(trips, zones, rules.TripRules()).collect()}
    assert kept == {k for k, (_, ok) in CASES.items() if ok}


def test_funnel_monotone_and_matches_clean(spark):
    trips, zones = _frames(spark)
    f = [r.rows_left for r in rules.attrition_funnel(trips, zones, rules.TripRules())
         .orderBy("step").collect()]
    assert f[0] == len(CASES)
    assert all(a >= b for a, b in zip(f, f[1:]))
    assert f[-1] == rules.clean_trips(trips, zones, rules.TripRules()).count()


def test_rejections_partition_all_rows(spark):
    trips, zones = _frames(spark)
    rej = rules.rule_rejections(trips, zones, rules.TripRules()).collect()
    assert sum(r.first_failed for r in rej) == len(CASES)
    alone = {r.rule: r.failed_alone for r in rej}
    assert alone["passengers"] == 2 and alone["tip"] == 2


def test_funnel_on_fixture_matches_published_fixture_counts(spark, sf_mid):
    # FIXTURES.md section 2: the funnel at sf0.01
    f = rules.attrition_funnel(fx.trips_view(spark, sf_mid), curated_zones(spark, sf_mid),
                               FIXTURE_RULES).orderBy("step")
    assert [r.rows_left for r in f.collect()] == [60000, 28028, 16497, 9844, 8883, 7908,
                                                  6827, 5876, 4951, 3746]


def test_single_filter_plan_pushes_into_scan(spark, sf_small):
    t = fx.trips_view(spark, sf_small)
    plan = t.where(rules.rule_columns(FIXTURE_RULES)["distance"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,0.0)" in plan


def test_zone_rules_agree(spark, sf_small):
    # The regex rule and the exclusion rule give one zone set
    z = fx.zone_attrs_view(spark, sf_small)
    a = {r.locationid for r in rules.filter_regex(z, "borough", "AFRICA|AMERICA|ASIA|EUROPE").collect()}
    b = {r.locationid for r in rules.filter_exclude(z, "borough", ["MIDDLE EAST"]).collect()}
    assert a == b and len(a) + 5 == 25


def test_clean_trips_matches_brute_force(spark):
    import random

    rnd = random.Random(11)
    r = rules.TripRules()
    zones = {1, 2, 3, 300}
    rows = []
    for i in range(600):
        pu = dt.datetime(2022, 7, 25) + dt.timedelta(hours=rnd.randint(0, 6000))
        do = pu + dt.timedelta(minutes=rnd.randint(-5, 60))
        rows.append((pu, do, rnd.choice([1, 2, 3, 4, 300, None]), rnd.choice([1, 2, 5, 300]),
                     rnd.choice([0.0, 0.5, 10.0, 50.0, 50.5, None]),
                     rnd.choice([-1.0, 0.0, 2.0, 30.0]), rnd.choice([2.0, 2.5, 30.0]),
                     rnd.choice([2.4, 2.5, 20.0, 499.99, 500.0]), rnd.choice([-0.1, 0.0, 0.5, 0.6]),
                     rnd.choice([0.0, 6.55, 256.95, 300.0]), rnd.choice([-1.0, 0.0, 2.5]),
                     rnd.choice([None, 0, 1, 6, 7]), rnd.choice([1, 6, 7, 99]),
                     rnd.choice([1, 2, 6, 7]), str(i)))

    def keep(t):
        (pu, do, pul, dol, dist, tip, tot, fare, tax, tolls, extra, n, rc, pay, _) = t
        vals = (pul, dol, dist, tip, tot, fare, tax, tolls, extra, n, rc, pay)
        if any(v is None for v in vals):
            return False
        return (dt.datetime(2022, 8, 1) <= pu < dt.datetime(2023, 4, 1)
                and pul in zones and dol in zones and pul <= 263 and dol <= 263
                and pu < do and 0 < dist <= 50 and 0 <= tip < tot
                and fare >= 2.5 and tot >= 2.5 and fare < 500
                and 0 <= tax <= 0.5 and 0 <= tolls <= 256.95 and extra >= 0
                and 0 < n <= 6 and rc <= 6 and pay <= 6)

    trips = spark.createDataFrame(rows, SCHEMA)
    zset = spark.createDataFrame([(z,) for z in zones], "locationid bigint")
    got = {x.tag for x in rules.clean_trips(trips, zset, r).collect()}
    assert got == {t[-1] for t in rows if keep(t)}
    funnel = [x.rows_left for x in rules.attrition_funnel(trips, zset, r).orderBy("step").collect()]
    assert funnel[-1] == len(got)
