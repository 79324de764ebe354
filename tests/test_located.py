import datetime

import pytest
from test_merge import flat, prices

from series_lake.functions.timeconv import DAY_MS
from series_lake.queries.projections import new_table
from series_lake.sinks import located


def test_days_are_swapped_whole_and_readers_keep_their_files(spark, monkeypatch):
    table, root = new_table(spark, "located")
    located.publish_located(spark, flat(spark, ("x", 1, 1), ("x", DAY_MS, 1), ("x", 5 * DAY_MS, 1), ("x", None, 1)), table, root)
    planned = spark.table(table).inputFiles()  # what a reader that started before will open
    real, done = located.point_day, []

    def failing(spark_, table_, version, day):
        if len(done) == 1:
            raise RuntimeError("lost the catalog")
        done.append(day)
        real(spark_, table_, version, day)

    monkeypatch.setattr(located, "point_day", failing)
    run = flat(spark, ("x", 1, 2), ("x", 2, 2), ("x", DAY_MS, 2), ("y", 9 * DAY_MS, 2), (None, None, 3))
    with pytest.raises(RuntimeError, match="catalog"):
        located.publish_located(spark, run, table, root)
    spark.catalog.refreshTable(table)
    half = {(c, t): p for c, t, p in prices(spark.table(table).where("timestamp is not null"))}
    assert half == {("x", 1): 2.0, ("x", 2): 2.0, ("x", DAY_MS): 1.0, ("x", 5 * DAY_MS): 1.0, ("y", 9 * DAY_MS): 2.0}
    assert spark.read.parquet(*planned).count() == 4  # none of these files is gone
    monkeypatch.setattr(located, "point_day", real)
    for _ in range(2):  # again, and once more without effect
        assert len(located.publish_located(spark, run, table, root)) == 4
        got = prices(spark.table(table).where("timestamp is not null"))
        assert got == [("x", 1, 2.0), ("x", 2, 2.0), ("x", DAY_MS, 2.0), ("x", 5 * DAY_MS, 1.0), ("y", 9 * DAY_MS, 2.0)]
        assert sorted(r.coin_id or "" for r in spark.table(table).where("date is null").collect()) == ["", "x"]
    assert located.remove_unused(spark, table, root, 3_600_000) == []
    gone = located.remove_unused(spark, table, root, 0)
    assert len(gone) == 2 and len(prices(spark.table(table).where("timestamp is not null"))) == 5


def test_only_the_days_of_a_run_are_read(spark):
    table, root = new_table(spark, "located")
    located.publish_located(spark, flat(spark, *[("x", d * DAY_MS, 1) for d in range(9)]), table, root)
    plan = located.read_days(spark, table, [datetime.date(1970, 1, 3)])._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan
    assert located.publish_located(spark, flat(spark, ("x", 1, 1)).where("false"), table, root) == []
    with pytest.raises(ValueError, match="schema"):
        located.publish_located(spark, flat(spark, ("x", 1, 1)), "plain", root)
