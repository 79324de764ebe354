from series_cases import bag, document
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
import pytest

from series_lake.functions.documents import build_envelope
from series_lake.operators.flatten import flatten_series, join_legs, leg_points, tagged_points
from series_lake.operators.merge import merge_history
from series_lake.operators.quality import reject_points
from series_lake.schemas import FLAT, RAW, RAW_STRICT, RAW_TYPED
from series_lake.sources.files import scan_raw, typed_copy

T0 = 1711111111999


def values(spark, folder, mode="coalesced", strategy="join"):
    raw = scan_raw(spark, folder, RAW_STRICT if mode == "strict" else RAW)
    flat = flatten_series(raw, mode, strategy)
    return sorted(map(tuple, flat.select("coin_id", "timestamp", "price", "market_cap", "volume").collect()))


@pytest.mark.parametrize("strategy", ["join", "keyed", "document"])
def test_schema_and_local_clock(spark, landed, strategy):
    raw = scan_raw(spark, landed(document("a", [[T0, 1.5]], [[T0, 2.5]], [[T0, 3.5]])))
    flat = flatten_series(raw, strategy=strategy)
    assert flat.columns == FLAT.names
    assert [f.dataType for f in flat.schema] == [f.dataType for f in FLAT]
    assert str(flat.first().date_time) == "2024-03-22 07:38:31"


@pytest.mark.parametrize("strategy", ["join", "keyed", "document"])
@pytest.mark.parametrize(
    "pair, coalesced, strict",
    [
        ([T0, 100], 100.0, None),
        ([T0, 100.5], 100.5, 100.5),
        ([T0, 1e30], 1e30, 1e30),
        ([T0, None], None, None),
        ([T0], None, None),
        ([T0, "n/a"], None, None),
        ([T0, "7.5"], 7.5, None),
    ],
)
def test_value_forms(spark, landed, strategy, pair, coalesced, strict):
    folder = landed(document("a", [pair, [T0 + 1, 9.5]], [[T0, 2.5], [T0 + 1, 2.5]], [[T0, 3.5], [T0 + 1, 3.5]]))
    other = ("a", T0 + 1, 9.5, 2.5, 3.5)
    assert values(spark, folder, "coalesced", strategy) == [("a", T0, coalesced, 2.5, 3.5), other]
    assert values(spark, folder, "strict", strategy) == [("a", T0, strict, 2.5, 3.5), other]


@pytest.mark.parametrize("strategy", ["join", "keyed", "document"])
def test_dropped_rows(spark, landed, strategy):
    folder = landed(
        document("null_time", [[None, 1.0]], [[None, 1.0]], [[None, 1.0]]),
        document("empty_leg", [[T0, 1.0]], [[T0, 1.0]], []),
        document("error", data={"status": {"error_code": 429}}),
        '{"coin_id": "missing"}',
        document("lacks_one", [[T0, 1.0], [T0 + 1, 1.0]], [[T0, 1.0]], [[T0, 1.0], [T0 + 1, 1.0]]),
    )
    assert values(spark, folder, strategy=strategy) == [("lacks_one", T0, 1.0, 1.0, 1.0)]


def test_exponent_times_are_read(spark, landed):
    line = '{"coin_id":"a","data":{"prices":[[1.7E12,1]],"market_caps":[[1700000000000,1]],"total_volumes":[[1.7E12,1]]}}'
    assert values(spark, landed(line)) == [("a", 1700000000000, 1.0, 1.0, 1.0)]


def test_repeated_instants_multiply(spark, landed):
    folder = landed(document("a", [[T0, 1.0], [T0, 2.0]], [[T0, 1.0], [T0, 2.0], [T0, 3.0]], [[T0, 9.0]]))
    for strategy in ("join", "document"):
        assert len(values(spark, folder, strategy=strategy)) == 6
    assert values(spark, folder, strategy="keyed") == [("a", T0, 2.0, 3.0, 9.0)]


def test_join_matches_across_documents(spark, landed):
    folder = landed(document("a", [[T0, 1.0]]), document("a", [], [[T0, 2.0]], [[T0, 3.0]]))
    assert values(spark, folder) == [("a", T0, 1.0, 2.0, 3.0)]
    assert values(spark, folder, strategy="keyed") == [("a", T0, 1.0, 2.0, 3.0)]


def test_keys_come_first_and_only_price_describes(spark, landed):
    raw = scan_raw(spark, landed(document("a", [[T0, 1.0]], [[T0, 1.0]], [[T0, 1.0]])))
    assert join_legs(raw).columns[:2] == ["coin_id", "timestamp"]
    assert leg_points(raw, "volume").columns == ["coin_id", "timestamp", "volume"]


def test_unknown_mode_or_strategy(spark, landed):
    raw = scan_raw(spark, landed(document()))
    with pytest.raises(ValueError):
        flatten_series(raw, strategy="other")
    with pytest.raises(ValueError):
        flatten_series(raw, mode="other")
    with pytest.raises(TypeError):
        flatten_series(raw, mode="strict")


pairs = st.lists(
    st.one_of(
        st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3))).map(list),
        st.tuples(st.none(), st.integers(0, 3)).map(list),
        st.integers(0, 4).map(lambda t: [t]),
    ),
    max_size=5,
)
maybe = st.one_of(st.none(), pairs)
aligned = st.lists(st.integers(0, 9), max_size=4).map(lambda ts: [[[t, t + 1] for t in ts]] * 3)
legs = st.one_of(st.lists(maybe, min_size=3, max_size=3), aligned)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(legs, min_size=1, max_size=4))
def test_strategies_agree(spark, documents):
    as_double = lambda leg: None if leg is None else [[None if x is None else float(x) for x in p] for p in leg]
    rows = [(f"c{i}", "n", "s", "im", i, tuple(map(as_double, d))) for i, d in enumerate(documents)]
    raw = spark.createDataFrame(rows, RAW_TYPED)
    joined = flatten_series(raw)
    assert bag(flatten_series(raw, strategy="document")) == bag(joined)
    assert bag(flatten_series(raw, strategy="keyed")) == bag(merge_history(joined))


def test_envelope_is_inverse_of_explode(spark):
    schema = "coin_id string, coin_name string, coin_symbol string, coin_image string, market_cap_rank long, timestamp long, price double, market_cap double, volume double"
    rows = [("a", "A", "a", "i", 1, t, t / 2, None if t % 2 else 1.0, 3.0) for t in range(7)] + [("b", "B", "b", "i", 2, 5, 1.0, 2.0, 3.0)]
    points = spark.createDataFrame(rows, schema).repartition(3)
    for element in ("double", "variant"):
        again = tagged_points(build_envelope(points, element))
        wide = again.groupBy("coin_id", "coin_name", "coin_symbol", "coin_image", "market_cap_rank", "timestamp").pivot(
            "leg", ["price", "market_cap", "volume"]
        ).agg(F.first("value"))
        assert bag(wide) == bag(points)
    ordered = build_envelope(points).where("coin_id = 'a'").first().data.prices
    assert [p[0] for p in ordered] == sorted(p[0] for p in ordered)
    assert isinstance(build_envelope(points, "variant").schema["data"].dataType["prices"].dataType.elementType.elementType, T.VariantType)


def test_typed_copy_changes_nothing(spark, landed, tmp_path):
    raw = scan_raw(
        spark,
        landed(
            document("a", [[T0, 100], [T0 + 1, "n/a"], [T0 + 2], [None, 1]], [[T0, 1], [T0 + 1, 2.5], [T0 + 2, 3]], [[T0, 1], [T0 + 1, 1], [T0 + 2, 1]]),
            '{"coin_id": "missing"}',
            document("error", data={"status": {}}),
        ),
    )
    copy = typed_copy(spark, raw, str(tmp_path / "copy"))
    assert copy.count() == 3 and copy.where("data IS NULL").count() == 1
    assert bag(flatten_series(copy)) == bag(flatten_series(raw))
    assert bag(tagged_points(copy)) == bag(tagged_points(raw))


def test_one_repeat_in_a_long_document(spark):
    n = 100_000
    leg = [[float(i), float(i)] for i in range(n)]
    repeated = [*leg, [5.0, 6.0]]
    raw = lambda prices: spark.createDataFrame([("a", "n", "s", "i", 1, (prices, leg[10:], leg[: n - 10]))], RAW_TYPED)
    assert flatten_series(raw(leg), strategy="document").count() == n - 20
    assert flatten_series(raw(repeated), strategy="document").count() == n - 20


def test_absurd_times_cost_one_point_each(spark, landed):
    good = [[T0, 1.0], [T0 + 1, 1.0]]
    folder = landed(document("a", [*good, [10**18, 1.0], [T0 * 1000, 1.0]], good, good))
    for strategy in ("join", "keyed", "document"):
        assert len(values(spark, folder, strategy=strategy)) == 2
    rejected = reject_points(scan_raw(spark, folder)).collect()
    assert sorted((r.leg, r.time, r.reason) for r in rejected) == sorted(("price", str(t), "time out of range") for t in (10**18, T0 * 1000))
