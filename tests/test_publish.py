import datetime
import pathlib

import pytest
from series_cases import bag, document
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from test_merge import flat, prices

from series_lake.functions.timeconv import DAY_MS
from series_lake.operators.flatten import tagged_points
from series_lake.queries.projections import new_table
from series_lake.schemas import FLAT, FLAT_DATED, RAW_STRICT, WH_HIST, WH_INTRA
from series_lake.sinks import publish as p
from series_lake.sinks import warehouse as w
from series_lake.sources import files
from series_lake.workspace import discard, shared_root


def failing(frame):
    return frame.withColumn("price", F.when(F.col("timestamp") >= 0, F.raise_error(F.lit("broken")).cast("double")))


def test_merge_rewrites_only_touched_days(spark, tmp_path):
    path = str(tmp_path / "h")
    p.publish_history(spark, flat(spark, ("x", 1, 1), ("x", DAY_MS, 2), ("x", 2 * DAY_MS, 3)), path)
    before = {f: f.stat().st_mtime_ns for f in pathlib.Path(path).rglob("*.parquet")}
    out = p.publish_history(spark, flat(spark, ("x", DAY_MS, 20), ("y", DAY_MS + 1, 21)), path)
    assert prices(out) == [("x", 1, 1.0), ("x", DAY_MS, 20.0), ("x", 2 * DAY_MS, 3.0), ("y", DAY_MS + 1, 21.0)]
    after = set(pathlib.Path(path).rglob("*.parquet"))
    assert {f.parent.name for f in before if f in after} == {"date=1970-01-01", "date=1970-01-03"}


def test_first_publish_is_deduplicated_and_dated(spark, tmp_path):
    out = p.publish_history(spark, flat(spark, ("x", -1, 1), ("x", -1, 2)), str(tmp_path / "h"))
    assert [(r.price, str(r.date)) for r in out.collect()] == [(2.0, "1969-12-31")]
    assert out.columns == FLAT_DATED.names


def test_failed_merge_keeps_history(spark, tmp_path):
    path = str(tmp_path / "h")
    first = bag(p.publish_history(spark, flat(spark, ("x", 1, 1)), path))
    with pytest.raises(Exception, match="broken"):
        p.publish_history(spark, failing(flat(spark, ("x", 1, 2))), path)
    assert bag(files.scan_published(spark, path)) == first


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_merge_reads_and_writes_the_same_folder(spark, tmp_path, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        path = str(tmp_path / "h")
        for price in (1, 2, 3):
            out = p.publish_history(spark, flat(spark, ("x", 1, price), ("y", price, price)), path)
        assert prices(out) == [("x", 1, 3.0), ("y", 1, 1.0), ("y", 2, 2.0), ("y", 3, 3.0)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_version_swap(spark):
    name, root = new_table(spark, "swap")
    p.publish_version(spark, flat(spark, ("x", 1, 1)), name, root, FLAT)
    with pytest.raises(Exception, match="broken"):
        p.publish_version(spark, failing(flat(spark, ("x", 1, 2))), name, root, FLAT)
    assert prices(spark.table(name)) == [("x", 1, 1.0)]
    # the load may read the table it replaces
    doubled = spark.table(name).withColumn("price", F.col("price") * 2)
    assert prices(p.publish_intra_day(spark, doubled, name, root)) == [("x", 1, 2.0)]
    # full replacement leaves nothing behind
    assert prices(p.publish_intra_day(spark, flat(spark, ("z", 9, 9)), name, root)) == [("z", 9, 9.0)]


def test_tables_need_their_schema(spark, tmp_path):
    with pytest.raises(ValueError):
        p.publish_version(spark, flat(spark), "bare", str(tmp_path), FLAT)
    with pytest.raises(ValueError):
        w.create_table(spark, "bare", WH_HIST, str(tmp_path / "t"))


def test_only_not_found_means_absent(spark, tmp_path):
    assert files.scan_if_exists(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception) as error:
        files.scan_if_exists(spark, "nosuchscheme://bucket/path")
    assert not (isinstance(error.value, AnalysisException) and error.value.getCondition() == "PATH_NOT_FOUND")


def test_create_or_replace_table(spark, tmp_path):
    name, _ = new_table(spark, "made")
    for schema, folder in ((WH_HIST, "a"), (WH_INTRA, "b")):
        w.create_table(spark, name, schema, str(tmp_path / folder))
        assert spark.table(name).schema.names == schema.names
        assert spark.table(name).count() == 0
    w.create_table(spark, name, WH_INTRA, str(tmp_path / "b"))  # the same place again
    (tmp_path / "file").write_text("no folder")
    with pytest.raises(Exception):
        w.create_table(spark, name, WH_HIST, str(tmp_path / "file"))
    assert spark.table(name).schema.names == WH_INTRA.names and spark.table(name).count() == 0


def test_mappings(spark):
    rows = spark.createDataFrame(
        [("u", 1711111111999, "N", "S", "i", 3, 1.25, 2.5, 7.0, None)], FLAT
    ).withColumn("date_time", F.expr("TIMESTAMP_NTZ'2024-03-22 07:38:31'"))
    hist, intra = w.map_hist(rows).first(), w.map_intra(rows).first()
    assert [(f.name, f.dataType) for f in w.map_hist(rows).schema] == [(f.name, f.dataType) for f in WH_HIST]
    assert [(f.name, f.dataType) for f in w.map_intra(rows).schema] == [(f.name, f.dataType) for f in WH_INTRA]
    assert (hist.id, hist.symbol, hist.name, hist.current_price, hist.market_cap, hist.market_cap_rank) == ("u", "S", "N", 1.25, 3.0, 3)
    assert hist.total_volume is None and str(hist.last_updated) == "2024-03-22 12:38:31.999000"
    assert (intra.market_cap, intra.total_volume, str(intra.last_updated)) == (2.5, 7.0, "2024-03-22 07:38:31")
    assert w.map_hist(rows, full=True).first().total_volume == 7.0
    assert str(w.map_intra(rows, utc=True).first().last_updated) == "2024-03-22 12:38:31.999000"


@pytest.mark.parametrize("land", ["per_asset", "bulk"])
def test_landing_replaces_per_asset(spark, landed, tmp_path, land):
    path = str(tmp_path / "zone")

    def put(run_type, *lines):
        docs = files.scan_raw(spark, landed(*lines, name=f"in{len(list(tmp_path.iterdir()))}"), RAW_STRICT)
        p.land_per_asset(docs, path, run_type) if land == "per_asset" else p.land_bulk(spark, docs, path, run_type)

    put("normal", document("a", [[1, 1.5]]), document("b", [[1, 1.5]]))
    put("intra_day", document("a", [[9, 9.5]]))
    put("normal", document("a", [[2, 2.5]]))
    back = lambda prefix: sorted((r.coin_id, r.timestamp, r.value) for r in tagged_points(files.scan_raw(spark, f"{path}/prefix={prefix}")).collect())
    assert back("historical_data") == [("a", 2, 2.5), ("b", 1, 1.5)]
    assert back("intra_day_data") == [("a", 9, 9.5)]


def test_corrupt_documents(spark, landed):
    folder = landed(document("a"), '{"coin_id": "b", "da')
    captured = files.scan_corrupt_capture(spark, folder).select("coin_id", files.CORRUPT).collect()
    assert sorted((r[0] or "", r[1] or "") for r in captured) == [("", '{"coin_id": "b", "da'), ("a", "")]
    with pytest.raises(Exception):
        files.scan_corrupt_capture(spark, folder, fail_fast=True).collect()


def test_catalog_scan(spark, landed):
    files.scan_raw(spark, landed(document("a"))).createOrReplaceTempView("raw_documents")
    assert files.scan_raw_table(spark, "raw_documents").first().coin_id == "a"


def test_staged_copies_are_removed(spark, landed, tmp_path):
    staged = lambda: {f for f in pathlib.Path(shared_root(spark), "series_lake").glob("*") if f.name.startswith(("staged-", "landing-"))}
    before = staged()
    p.publish_history(spark, flat(spark, ("x", 1, 1)), str(tmp_path / "h"))
    with pytest.raises(Exception, match="broken"):
        p.publish_history(spark, failing(flat(spark, ("x", 1, 2))), str(tmp_path / "h"))
    docs = files.scan_raw(spark, landed(document("a", [[1, 1.5]])), RAW_STRICT)
    p.land_bulk(spark, docs, str(tmp_path / "zone"), "normal")
    with pytest.raises(Exception, match="broken"):
        p.land_bulk(spark, docs.withColumn("coin_name", F.raise_error(F.lit("broken"))), str(tmp_path / "zone"), "normal")
    assert staged() == before
    with pytest.raises(ValueError):
        discard(spark, str(tmp_path / "h"))


def test_merge_prunes_other_days(spark, tmp_path):
    path = str(tmp_path / "h")
    p.publish_history(spark, flat(spark, ("x", 1, 1), ("x", DAY_MS, 2), ("x", 9 * DAY_MS, 3)), path)
    days = [datetime.date(1970, 1, 1), datetime.date(1970, 1, 10)]
    current = p.published_days(spark, path, days)
    assert "PartitionFilters: [date" in current._jdf.queryExecution().executedPlan().toString()
    assert prices(current) == [("x", 1, 1.0), ("x", 9 * DAY_MS, 3.0)]
    assert {f.split("date=")[1][:10] for f in current.inputFiles()} >= {"1970-01-01", "1970-01-10"}


def test_empty_run_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "h")
    assert p.publish_history(spark, flat(spark), path).count() == 0
    p.publish_history(spark, flat(spark, ("x", 1, 1)), path)
    assert prices(p.publish_history(spark, flat(spark), path)) == [("x", 1, 1.0)]


def test_rows_without_a_time_are_kept(spark, tmp_path):
    path = str(tmp_path / "h")
    p.publish_history(spark, flat(spark, ("x", None, 1), ("x", 1, 1)), path)
    out = p.publish_history(spark, flat(spark, ("y", None, 2), ("x", 2, 2)), path)
    assert sorted((r.coin_id, r.price) for r in out.collect()) == [("x", 1.0), ("x", 1.0), ("x", 2.0), ("y", 2.0)]


def test_absurd_times_go_their_own_way(spark, tmp_path):
    path = str(tmp_path / "h")
    out = p.publish_history(spark, flat(spark, ("x", 10**18, 1), ("x", 1711111111999000, 2), ("x", 1, 3)), path)
    assert sorted((r.timestamp, r.date is None) for r in out.collect()) == [(1, False), (1711111111999000, True), (10**18, True)]
    assert w.map_hist(out).where("last_updated IS NULL").count() == 2
    many = spark.range(50).selectExpr("date_from_unix_date(cast(id as int)) AS date")
    with pytest.raises(ValueError, match="more than 10 days"):
        p.touched_days(many, 10)


def test_landing_touches_only_the_folders_of_its_assets(spark, landed, tmp_path):
    path = tmp_path / "zone"
    docs = files.scan_raw(spark, landed(*[document(f"a{i}", [[1, 1.5]]) for i in range(40)], '{"coin_name": "none"}'), RAW_STRICT)
    p.land_bulk(spark, docs, str(path), "normal")
    before = {f: f.stat().st_mtime_ns for f in path.rglob("*.json")}
    for _ in range(2):
        one = files.scan_raw(spark, landed(document("a7", [[2, 2.5]]), '{"coin_name": "none"}', name="one"), RAW_STRICT)
        p.land_bulk(spark, one.limit(2), str(path), "normal")
    after = {f: f.stat().st_mtime_ns for f in path.rglob("*.json")}
    assert len({f.parent for f in before if f not in after}) <= 2
    again = files.scan_raw(spark, f"{path}/prefix=historical_data")
    assert again.where("coin_id IS NULL").count() == 1 and again.where("coin_id IS NOT NULL").count() == 40


def test_versions_kept(spark):
    name, root = new_table(spark, "versions")
    for price in (1, 2, 3, 4):
        p.publish_version(spark, flat(spark, ("x", 1, price)), name, root, FLAT, keep=2)
    assert len(list(pathlib.Path(root).glob("v=*"))) == 2
    assert prices(spark.table(name)) == [("x", 1, 4.0)]
