"""K1 month commits and the clustered layout."""

import pytest
from pyspark.sql import functions as F

from zonecast.operators import combine
from zonecast.session import scratch_path
from zonecast.sinks import clustered, commits

SCHEMA = "id int, v string, source_month string"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


FIRST = [(1, "a", "2024-01"), (2, None, "2024-01"), (2, None, "2024-01"), (3, "b", "2024-02")]


def _seen(spark, root, schema):
    return sorted(map(tuple, commits.read_months(spark, root, schema).collect()), key=repr)


def test_a_rerun_writes_nothing_and_a_change_writes_its_month(spark):
    root, df = scratch_path(spark, "months"), _rows(spark, FIRST)
    assert commits.commit_months(df, root).written == ("2024-01", "2024-02")
    again = commits.commit_months(df.repartition(3).orderBy(F.desc("id")), root)
    assert again == commits.Commit(None, (), ("2024-01", "2024-02"))
    assert commits.records(spark, root).count() == 2
    new = _rows(spark, [*FIRST[:2], FIRST[3]])                      # one of two equal rows less
    third = commits.commit_months(new, root)
    assert third.written == ("2024-01",) and third.unchanged == ("2024-02",)
    assert _seen(spark, root, df.schema) == sorted(map(tuple, new.collect()), key=repr)
    assert {r.month: (r.n_rows, r.n_commits) for r in commits.manifest(spark, root).collect()} == {
        "2024-01": (2, 2), "2024-02": (1, 1)}
    # a month alone: the others stay
    commits.commit_months(_rows(spark, [(9, "z", "2024-03")]), root)
    assert {r[2] for r in _seen(spark, root, df.schema)} == {"2024-01", "2024-02", "2024-03"}


def test_a_write_that_dies_before_its_commit_is_not_seen(spark, monkeypatch):
    root, df = scratch_path(spark, "months"), _rows(spark, FIRST)
    commits.commit_months(df, root)
    before = _seen(spark, root, df.schema)
    changed = _rows(spark, [(7, "new", "2024-01")])
    commits.write_version(changed, root, "dead")                    # data, no record
    assert _seen(spark, root, df.schema) == before

    def dies(*args, **kw):
        raise RuntimeError("lost")

    monkeypatch.setattr(commits, "read_version", dies)
    with pytest.raises(RuntimeError):
        commits.commit_months(changed, root)
    assert _seen(spark, root, df.schema) == before
    monkeypatch.undo()
    # rows that come back different are not committed
    monkeypatch.setattr(commits, "write_version", lambda d, r, v, m: d.limit(0).write.partitionBy(m).parquet(f"{r}/data/{v}"))
    with pytest.raises(OSError, match="not committed"):
        commits.commit_months(changed, root)
    assert _seen(spark, root, df.schema) == before


def test_digest_sees_values_nulls_repeats_but_no_order(spark):
    def digest(rows):
        return commits.month_digests(_rows(spark, rows)).first().digest

    base = [(1, "a", "m"), (2, None, "m")]
    assert digest(base) == digest(base[::-1])
    others = [[(1, "a", "m"), (2, "", "m")], [(1, None, "m"), (2, "a", "m")], base + [base[0]], [(1, "a", "m"), (3, None, "m")],
              [(None, "a", "m"), (2, None, "m")]]
    assert len({digest(base), *map(digest, others)}) == 6


def test_empty_root_and_rows_without_a_month(spark):
    root, df = scratch_path(spark, "months"), _rows(spark, FIRST)
    assert commits.read_months(spark, root, df.schema).count() == 0
    assert commits.commit_months(df.limit(0), root) == commits.Commit(None, (), ())
    with pytest.raises(ValueError, match="without a month"):
        commits.commit_months(_rows(spark, [(1, "a", None)]), root)


def test_clustered_sides_hold_all_rows_and_one_file_a_bucket(spark):
    rows = spark.range(500).select((F.col("id") % 37).alias("locationid"), F.col("id").alias("v"))
    path = scratch_path(spark, "clustered")
    name = clustered.write_clustered(rows, path, ["locationid"], buckets=4)
    back = clustered.read_clustered(spark, name)
    assert back.exceptAll(rows).count() == 0 and back.count() == 500
    assert len(back.inputFiles()) == 4
    plan = back.groupBy("locationid").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_join_of_clustered_sides_equals_the_plain_join(spark, sf_small):
    from zonecast.plans import demand
    from zonecast.plans.queries_io import clustered_sides

    a = combine.combined_demand(*clustered_sides(spark, sf_small))
    b = demand.combined(spark, sf_small)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
