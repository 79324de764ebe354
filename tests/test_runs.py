import json
import pathlib

import pytest
from series_cases import document

from series_lake.__main__ import main
from series_lake.functions.timeconv import DAY_MS
from series_lake.operators.flatten import flatten_series, tagged_points
from series_lake.plans import runs
from series_lake.queries.projections import new_table
from series_lake.schemas import FLAT_DATED, MARKETS, RAW_LANDED
from series_lake.sources.files import scan_raw

T0 = 1711065600000


@pytest.mark.parametrize("strategy", ["join", "document"])
def test_run_intra_day(spark, landed, capsys, strategy):
    (table, table_root), (wh, wh_root) = new_table(spark, "flat"), new_table(spark, "intra")
    for price in (1.5, 2.5):  # the second run replaces the first
        raw = landed(document("a", [[T0, price]], [[T0, 10]], [[T0, 7]]), name=f"raw{price}")
        main(["run-intra-day", "--raw", raw, "--table", table, "--table-root", table_root, "--wh-table", wh, "--wh-root", wh_root, "--strategy", strategy])
    row = spark.table(wh).collect()
    assert [(r.id, r.current_price, r.market_cap, r.total_volume, str(r.last_updated)) for r in row] == [("a", 2.5, 10.0, 7.0, "2024-03-21 19:00:00")]
    assert spark.table(table).count() == 1
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["rows"] == 1


def test_run_historical(spark, landed, tmp_path, capsys):
    wh, wh_root = new_table(spark, "hist")
    history = str(tmp_path / "history")
    first = [[T0, 1.0], [T0 + DAY_MS, 1.0]]
    second = [[T0 + DAY_MS, 2.0], [T0 + 2 * DAY_MS, 2.0], [T0 + 2 * DAY_MS, 1.0]]
    for n, points in enumerate((first, second, second)):
        raw = landed(document("a", points, points, points), name=f"raw{n}")
        main(["run-historical", "--raw", raw, "--history", history, "--wh-table", wh, "--wh-root", wh_root])
    got = sorted((str(r.last_updated)[:10], r.current_price) for r in spark.table(wh).collect())
    assert got == [("2024-03-22", 1.0), ("2024-03-23", 2.0), ("2024-03-24", 2.0)]
    summary = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert (summary["rows"], summary["assets"]) == (3, 1)


def test_prepare_raw(spark, tmp_path):
    markets, points, landing = (str(tmp_path / n) for n in ("markets", "points", "landing"))
    listing = [(f"c{i}", f"C{i}", f"s{i}", "img", i + 1, float(100 - i)) for i in range(5)]
    spark.createDataFrame(listing, MARKETS).write.json(markets)
    rows = [(f"c{i}", T0 - d * DAY_MS, None, None, None, None, 1.005 * d + i, 2.0, 3.0, None, None) for i in range(5) for d in range(400)]
    spark.createDataFrame(rows, FLAT_DATED).drop("date").selectExpr("*", f"date_from_unix_date(cast(timestamp div {DAY_MS} as int)) AS date").write.parquet(points)
    main(["prepare-raw", "--markets", markets, "--points", points, "--landing", landing, "--as-of-ms", str(T0), "--top", "2"])
    landed = tagged_points(scan_raw(spark, f"{landing}/prefix=historical_data"))
    assert {(r.coin_id, r.leg): r["count"] for r in landed.groupBy("coin_id", "leg").count().collect()} == {
        (c, leg): 366 for c in ("c0", "c1") for leg in ("price", "market_cap", "volume")
    }
    assert landed.where("leg = 'price' AND round(value, 2) != value").count() == 0
    assert {(r.coin_id, r.coin_name, r.market_cap_rank) for r in landed.select("coin_id", "coin_name", "market_cap_rank").distinct().collect()} == {("c0", "C0", 1), ("c1", "C1", 2)}


def test_silent_asset_gets_an_empty_document(spark, tmp_path):
    landing = str(tmp_path / "landing")
    listing = spark.createDataFrame([("a", "A", "a", "i", 1, 9.0), ("b", "B", "b", "i", 2, 8.0)], MARKETS)
    points = lambda *rows: spark.createDataFrame([(c, t, 1.0, 1.0, 1.0, q) for c, t, q in rows], "coin_id string, timestamp long, price double, market_cap double, volume double, quote_currency string")
    prepare = lambda at, *rows: runs.prepare_raw(listing, points(*rows), landing, "intra_day", at, currency="usd")
    prepare(T0, ("a", T0, "usd"), ("b", T0, "usd"), ("a", T0 - 1, "eur"))
    prepare(T0 + 8 * DAY_MS, ("a", T0 + 8 * DAY_MS, "usd"), ("b", T0, "usd"))
    docs = scan_raw(spark, f"{landing}/prefix=intra_day_data")
    assert {(r.coin_id, len(r.data.prices)) for r in docs.collect()} == {("a", 1), ("b", 0)}
    # an asset of more points than a document holds is landed in segments
    many = [("a", T0 - i, "usd") for i in range(9)] + [("b", T0, "usd")]
    runs.prepare_raw(listing, points(*many), landing, "normal", T0, segment_points=2)
    raw = scan_raw(spark, f"{landing}/prefix=historical_data", RAW_LANDED)
    sizes = [len(r.data.prices) for r in raw.where("coin_id = 'a'").collect()]
    assert sum(sizes) == 9 and max(sizes) <= 4
    for strategy in ("document", "join", "keyed"):
        assert sorted((r.coin_id, r.timestamp) for r in flatten_series(raw, strategy=strategy).collect()) == sorted((c, t) for c, t, _ in many)
    runs.prepare_raw(listing, points(("a", T0, "usd")), landing, "normal", T0, segment_points=2)
    assert [len(r.data.prices) for r in scan_raw(spark, f"{landing}/prefix=historical_data").where("coin_id = 'a'").collect()] == [1]


def test_rejects_and_fail_fast(spark, landed, tmp_path):
    wh, wh_root = new_table(spark, "rejects")
    good = [[T0, 1.0]]
    raw = landed(document("a", [*good, [10**18, 2.0]], good, good), '{"coin_id": "b", "da', document("c", good))
    args = (spark, raw, str(tmp_path / "h"), wh, wh_root)
    assert runs.run_historical(*args, rejects=str(tmp_path / "rejects")).count() == 1
    found = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert sorted((r.kind, r.coin_id or "", r.reason) for r in found) == [
        ("document", "", "unreadable"), ("document", "c", "market_caps,total_volumes"), ("point", "a", "time out of range"),
    ]
    with pytest.raises(Exception):
        runs.run_historical(*args, fail_fast=True)


def test_untouched_days_keep_their_files(spark, landed, tmp_path):
    wh, wh_root = new_table(spark, "days")
    day = lambda n, price: [T0 + n * DAY_MS, price]
    for metrics in (False, True):
        for i, points in enumerate(([day(0, 1.0), day(1, 1.0), day(9, 1.0)], [day(1, 2.0)])):
            before = {f: f.stat().st_mtime_ns for f in pathlib.Path(wh_root).rglob("*.parquet")}
            raw = landed(document("a", points, points, points), name=f"raw{metrics}{i}")
            loaded = runs.run_historical(spark, raw, str(tmp_path / "h"), wh, wh_root, metrics=metrics)
        after = {f: f.stat().st_mtime_ns for f in pathlib.Path(wh_root).rglob("*.parquet")}
        kept = {f.parent.name for f in before if after.get(f) == before[f]}
        assert kept >= {"load_day=2024-03-22", "load_day=2024-03-31"}
        assert sorted(r.current_price for r in loaded.collect()) == [1.0, 1.0, 2.0]
    assert sorted(r.high_24h for r in loaded.where("high_24h IS NOT NULL").collect())[-1] == 2.0
