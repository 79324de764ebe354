import pytest
from series_cases import bag
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from series_lake.operators import merge as m
from series_lake.schemas import FLAT


def flat(spark, *rows):
    full = [(c, t, "n", "s", "i", 1, float(p) if p is not None else None, 1.0, 1.0, None) for c, t, p in rows]
    return spark.createDataFrame(full, FLAT)


def prices(frame):
    return sorted((r.coin_id, r.timestamp, r.price) for r in frame.collect())


def test_incoming_wins(spark):
    a, b = flat(spark, ("x", 1, 5), ("x", 2, 5)), flat(spark, ("x", 1, 9), ("x", 3, 9))
    assert prices(m.merge_history(a, b)) == [("x", 1, 5.0), ("x", 2, 5.0), ("x", 3, 9.0)]


def test_ties_are_decided_by_value_and_null_loses(spark):
    a = flat(spark, ("x", 1, 5), ("x", 1, 7), ("x", 1, None))
    for parts in (1, 3):
        assert prices(m.merge_history(a.repartition(parts))) == [("x", 1, 7.0)]


def test_idempotent(spark):
    a, b = flat(spark, ("x", 1, 5), ("y", 2, 5)), flat(spark, ("x", 1, 9), ("x", 3, 9))
    once = m.merge_history(a, b)
    assert bag(m.merge_history(once, b)) == bag(once)
    assert bag(m.merge_history(a, once)) == bag(once)


def test_first_run_is_deduplicated(spark):
    a = flat(spark, ("x", 1, 5), ("x", 1, 5), ("x", 1, 6))
    assert prices(m.merge_history(a)) == [("x", 1, 6.0)]
    assert prices(m.merge_history(a, spark.createDataFrame([], FLAT))) == [("x", 1, 6.0)]


def test_union_by_name(spark):
    a = flat(spark, ("x", 1, 5))
    swapped = a.select(*reversed(a.columns))
    assert m.union_by_name(a, swapped).distinct().count() == 1
    with pytest.raises(AnalysisException):
        m.union_by_name(a, a.drop("price"))
    assert m.union_by_name(a, a.drop("price"), allow_missing=True).where(F.col("price").isNull()).count() == 1


def test_dedupe_keys(spark):
    assert m.dedupe_keys(flat(spark, ("x", 1, 5), ("x", 1, 6), ("y", 1, 6))).count() == 2


def test_hot_key_is_combined_before_the_exchange(spark):
    hot = spark.range(0, 100_000, 1, 8).select(F.lit("x").alias("coin_id"), F.lit(1).cast("long").alias("timestamp"), F.col("id").alias("v"))
    plan = m.merge_history(hot)._jdf.queryExecution().toString()
    assert "partial_max" in plan
    assert [tuple(r) for r in m.merge_history(hot).collect()] == [("x", 1, 99_999)]
