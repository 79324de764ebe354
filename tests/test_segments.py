import random
from collections import Counter

import pytest
from series_cases import bag

from series_lake.functions.documents import build_envelope, with_segments
from series_lake.functions.timeconv import DAY_MS
from series_lake.operators.flatten import flatten_series
from series_lake.schemas import RAW_LANDED
from series_lake.sinks.publish import land_bulk
from series_lake.sources.files import scan_raw, typed_copy

COLUMNS = "coin_id string, timestamp long, coin_name string, coin_symbol string, coin_image string, market_cap_rank long, price double, market_cap double, volume double"


def points(spark, rows):
    return spark.createDataFrame([(c, t, "n", "s", "i", 1, 1.0 * k, 2.0, 3.0) for k, (c, t) in enumerate(rows)], COLUMNS).repartition(3)


def series():
    rng = random.Random(2)
    rows = [("daily", d * DAY_MS) for d in range(-30, 60)]
    rows += [("dense day", 5 * DAY_MS + 1000 * i) for i in range(700)] + [("dense day", d * DAY_MS) for d in (4, 6, 7)]
    rows += [("dense minute", 7 * DAY_MS + i) for i in range(500)] + [("dense minute", 7 * DAY_MS + 70_000 * i) for i in range(1, 40)]
    rows += [("mixed", rng.randrange(9 * DAY_MS)) for _ in range(400)]
    return list(dict.fromkeys(rows))


@pytest.mark.parametrize("most", [1, 10, 64])
def test_segments_are_bounded_whole_and_in_order(spark, most):
    rows = series() + [("same instant", 3)] * 30 + [(None, 5), ("no time", None)]
    got = with_segments(points(spark, rows), most).select("coin_id", "timestamp", "segment").collect()
    assert Counter((r.coin_id, r.timestamp) for r in got) == Counter(rows)
    keyed = [r for r in got if r.coin_id is not None and r.timestamp is not None]
    sizes = Counter((r.coin_id, r.segment) for r in keyed if r.coin_id != "same instant")
    assert max(sizes.values()) <= 2 * most
    assert len({(r.coin_id, r.timestamp) for r in keyed}) == len({(r.coin_id, r.timestamp, r.segment) for r in keyed})
    spans = {}
    for r in keyed:
        low, high = spans.get((r.coin_id, r.segment), (r.timestamp, r.timestamp))
        spans[r.coin_id, r.segment] = (min(low, r.timestamp), max(high, r.timestamp))
    for coin in {c for c, _ in spans}:
        own = sorted((*v, s) for (c, s), v in spans.items() if c == coin)
        assert all(low == s for low, _, s in own)
        assert all(a[1] < b[0] for a, b in zip(own, own[1:], strict=False))
    assert {r.segment for r in got if r.coin_id is None or r.timestamp is None} == {0}


def test_segmented_landing_flattens_like_whole_documents(spark, tmp_path):
    frame = points(spark, series()).cache()
    land_bulk(spark, build_envelope(with_segments(frame, 50), "variant", segmented=True), str(tmp_path / "zone"), "normal")
    raw = scan_raw(spark, str(tmp_path / "zone"), RAW_LANDED)
    want = bag(flatten_series(build_envelope(frame), strategy="join"))
    for strategy in ("join", "keyed", "document"):
        assert bag(flatten_series(raw, strategy=strategy)) == want
    copy = typed_copy(spark, raw, str(tmp_path / "copy"))
    assert bag(flatten_series(copy, strategy="document")) == want
    with pytest.raises(Exception, match="several documents"):
        flatten_series(raw.drop("segment"), strategy="document").collect()
    # assets that a later landing does not deliver keep their segments
    land_bulk(spark, build_envelope(points(spark, [("daily", 0)]), "variant"), str(tmp_path / "zone"), "normal")
    after = flatten_series(scan_raw(spark, str(tmp_path / "zone"), RAW_LANDED), strategy="document")
    assert after.count() == len([r for r in series() if r[0] != "daily"]) + 1


def test_segments_of_odd_tables(spark):
    assert with_segments(points(spark, [("a", 1)]).where("false")).count() == 0
    assert build_envelope(with_segments(points(spark, [("a", 1)])), segmented=True).columns == ["coin_id", "coin_name", "coin_symbol", "coin_image", "market_cap_rank", "segment", "data"]
