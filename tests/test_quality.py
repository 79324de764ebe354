from series_cases import document
from pyspark.sql import functions as F

from series_lake.operators import quality as q
from series_lake.operators.flatten import flatten_series, leg_points
from series_lake.sources.files import scan_raw


def lines():
    return [
        document("ok", [[1, 1.0], [2, None], [3, 1.0], [None, 4.0]], [[1, 1.0], [2, 1.0]], [[1, 1.0], [2, 1.0], [4, 1.0]]),
        document("empty", [[1, 1.0]], [[1, 1.0]], []),
        document("error", data={"status": {"error_code": 429}}),
        '{"coin_id": "missing"}',
    ]


def test_rejects(spark, landed):
    got = {r.coin_id: r.reason for r in q.reject_documents(scan_raw(spark, landed(*lines()))).collect()}
    assert got == {"empty": "total_volumes", "error": "prices,market_caps,total_volumes", "missing": "no data"}


def test_null_values(spark, landed):
    got = {(r.coin_id, r.leg): (r.points, r.null_times, r.null_values) for r in q.null_value_audit(scan_raw(spark, landed(*lines()))).collect()}
    assert got["ok", "price"] == (4, 1, 1)
    assert got["ok", "volume"] == (3, 0, 0)
    assert ("empty", "volume") not in got


def test_every_price_point_is_accounted_for(spark, landed):
    raw = scan_raw(spark, landed(*lines()))
    prices = leg_points(raw, "price")
    joined = flatten_series(raw).count()
    unmatched = q.unmatched_keys(raw).agg(F.sum("price_points")).first()[0]
    keyless = prices.where("timestamp IS NULL OR coin_id IS NULL").count()
    assert prices.count() == joined + unmatched + keyless
    missing = {(r.coin_id, r.timestamp): r.missing for r in q.unmatched_keys(raw).collect()}
    assert missing == {("ok", 3): "market_cap,volume", ("ok", 4): "price,market_cap", ("empty", 1): "volume"}


def test_duplicates_and_summary(spark):
    flat = spark.createDataFrame([("a", 1), ("a", 1), ("b", 86_400_000)], "coin_id string, timestamp long")
    assert [tuple(r) for r in q.duplicate_keys(flat).collect()] == [("a", 1, 2)]
    s = q.load_summary(flat).first()
    assert (s.rows, s.assets, str(s.first_time), str(s.last_time)) == (3, 2, "1970-01-01 00:00:00.001000", "1970-01-02 00:00:00")
    assert q.load_summary(flat.limit(0)).first().rows == 0
