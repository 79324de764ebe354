"""Documents with three parallel arrays of pairs to one keyed fact table.

Three strategies, by what may be assumed and what they cost:

``join``      Exact bag semantics of joining the legs on (asset, instant): an instant that a
              leg lacks is dropped, repeated instants multiply. Three scans, three exchanges;
              the second join reuses the partitioning of the first, and adaptive skew
              handling splits hot partitions.
``keyed``     One row per key: exactly what de-duplicating the ``join`` result under the
              merge's winner rule leaves. One scan and one exchange, and the three legs of
              a document are combined before the exchange, so repeated keys cost nothing.
``document``  Legs are matched inside each document, in one pass without an exchange of points.
              Equals ``join`` when no asset, or segment of an asset, occurs in two documents,
              which the landing step guarantees and this strategy checks: such an asset is
              an error, not a silent loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from series_lake.functions.choice import choice_double, choice_long, element, element_type
from series_lake.functions.timeconv import local_clock, valid_ms
from series_lake.schemas import DESCRIPTIVE, FLAT_COLUMNS, KEY, LEG_ARRAYS, LEGS

STRATEGIES = ("join", "keyed", "document")


def point_time(pair: Column, dtype: T.DataType, mode: str) -> Column:
    """The time of a pair; NULL where it cannot be read or lies outside the valid range."""
    return valid_ms(choice_long(element(pair, 0), dtype, mode))


def leg_points(raw: DataFrame, leg: str, mode: str = "coalesced") -> DataFrame:
    """One row per pair of a leg. Documents without that array give no rows.

    Only the price leg carries the descriptive columns.
    """
    dtype = element_type(raw)
    carried = DESCRIPTIVE if leg == "price" else []
    pairs = raw.select("coin_id", *carried, F.explode(f"data.{LEG_ARRAYS[leg]}").alias("pair"))
    return pairs.select(
        "coin_id",
        *carried,
        point_time(F.col("pair"), dtype, mode).alias("timestamp"),
        choice_double(element(F.col("pair"), 1), dtype, mode).alias(leg),
    )


def join_legs(raw: DataFrame, legs: tuple[str, ...] = LEGS, mode: str = "coalesced") -> DataFrame:
    """Inner join of the legs on (asset, instant), keys first."""
    first, *others = [leg_points(raw, leg, mode) for leg in legs]
    for other in others:
        first = first.join(other, KEY, "inner")
    return first


def tagged_points(raw: DataFrame, mode: str = "coalesced") -> DataFrame:
    """All legs in one scan: a row per pair with the name of its leg."""
    dtype = element_type(raw)
    arrays = F.array(*[
        F.struct(F.lit(leg).alias("leg"), F.col(f"data.{name}").alias("pairs")) for leg, name in LEG_ARRAYS.items()
    ])
    by_leg = raw.select("coin_id", *DESCRIPTIVE, F.inline(arrays))
    pairs = by_leg.select("coin_id", *DESCRIPTIVE, "leg", F.explode("pairs").alias("pair"))
    return pairs.select(
        "coin_id",
        *DESCRIPTIVE,
        "leg",
        point_time(F.col("pair"), dtype, mode).alias("timestamp"),
        choice_double(element(F.col("pair"), 1), dtype, mode).alias("value"),
    )


def keyed_legs(raw: DataFrame, mode: str = "coalesced") -> DataFrame:
    """One row per key that all legs have; the largest entry of each leg wins.

    Entries are structs, so a NULL value still counts as an entry (and loses to a value).
    """
    described = F.struct(*DESCRIPTIVE, F.col("value"))
    best = {leg: F.max(F.when(F.col("leg") == leg, described if leg == "price" else F.struct("value"))).alias(leg) for leg in LEGS}
    keyed = (
        tagged_points(raw, mode)
        .where(F.col("coin_id").isNotNull() & F.col("timestamp").isNotNull())
        .groupBy(*KEY)
        .agg(*best.values())
        .where(" AND ".join(f"{leg} IS NOT NULL" for leg in LEGS))
    )
    return keyed.select(
        *KEY, *[F.col(f"price.{c}").alias(c) for c in DESCRIPTIVE], *[F.col(f"{leg}.value").alias(leg) for leg in LEGS]
    )


def _points(leg: str, dtype: T.DataType, mode: str) -> Column:
    """The readable points of a leg as array<struct<t, v>>."""
    typed = F.transform(
        F.col(f"data.{LEG_ARRAYS[leg]}"),
        lambda pair: F.struct(point_time(pair, dtype, mode).alias("t"), choice_double(element(pair, 1), dtype, mode).alias("v")),
    )
    return F.filter(typed, lambda p: p["t"].isNotNull())


def document_rows(raw: DataFrame, mode: str = "coalesced", carried: tuple[str, ...] = (), keep_empty: bool = False) -> DataFrame:
    """Legs matched inside each document: one pass, no exchange, no join.

    Instants that no leg repeats are cut to those all legs have, sorted and zipped, which takes
    n log n steps however much the legs differ. Instants that a leg repeats multiply, each with its
    own points only. ``carried`` columns are kept; with ``keep_empty`` a document without rows
    gives one row without time.
    """
    dtype = element_type(raw)
    described = ["coin_id", *DESCRIPTIVE, *carried]
    typed = raw.where(F.col("coin_id").isNotNull()).select(*described, *[_points(leg, dtype, mode).alias(leg) for leg in LEGS])
    each = lambda form: [form.format(leg=leg) for leg in LEGS]
    # A leg whose instants differ, nearly every one, is not sorted to look for repeats.
    times = typed.selectExpr("*", *each("CASE WHEN size(array_distinct({leg}.t)) < size({leg}) THEN array_sort({leg}.t) END AS {leg}_times"))
    again = each("coalesce(filter({leg}_times, (t, i) -> i > 0 AND get({leg}_times, greatest(i - 1, 0)) = t), CAST(array() AS array<bigint>))")
    common = "array_intersect(array_intersect(price.t, market_cap.t), volume.t)"
    told = times.selectExpr(*described, *LEGS, f"{common} AS common", f"array_distinct(concat({', '.join(again)})) AS repeated")
    told = told.selectExpr(
        *described, *LEGS,
        "CASE WHEN size(repeated) > 0 THEN array_except(common, repeated) ELSE common END AS single",
        "CASE WHEN size(repeated) > 0 THEN array_intersect(common, repeated) END AS multiple",
    )
    # A mark per single common instant sorts right before its point.
    mark = "transform(single, t -> struct(t AS t, 0 AS point, CAST(NULL AS DOUBLE) AS v))"
    marked = told.selectExpr(
        *described,
        *each(f"array_sort(concat({mark}, transform({{leg}}, p -> struct(p.t AS t, 1 AS point, p.v AS v)))) AS {{leg}}_marked"),
        *each("CASE WHEN size(multiple) > 0 THEN filter({leg}, p -> array_contains(multiple, p.t)) END AS {leg}_some"),
    )
    after_mark = "p.point = 1 AND get({leg}_marked, greatest(i - 1, 0)).point = 0 AND get({leg}_marked, greatest(i - 1, 0)).t = p.t"
    aligned = marked.selectExpr(*described, *each("{leg}_some"), *each(f"filter({{leg}}_marked, (p, i) -> {after_mark}) AS {{leg}}_kept"))
    row = "struct({t} AS timestamp, {p} AS price, {c} AS market_cap, {v} AS volume)"
    zipped = "transform(arrays_zip(price_kept, market_cap_kept, volume_kept), z -> " + row.format(t="z.price_kept.t", p="z.price_kept.v", c="z.market_cap_kept.v", v="z.volume_kept.v") + ")"
    crossed = (
        "flatten(transform(price_some, p -> flatten(transform(filter(market_cap_some, o -> o.t = p.t), c -> "
        "transform(filter(volume_some, o -> o.t = p.t), v -> " + row.format(t="p.t", p="p.v", c="c.v", v="v.v") + ")))))"
    )
    both = F.expr(f"CASE WHEN price_some IS NULL THEN {zipped} ELSE concat({zipped}, {crossed}) END")
    explode = F.inline_outer if keep_empty else F.inline
    return aligned.select(*described, explode(both)).select(*KEY, *DESCRIPTIVE, *carried, *LEGS)


def document_legs(raw: DataFrame, mode: str = "coalesced") -> DataFrame:
    """``document_rows`` of documents that hold whole assets, or whole segments of assets (column
    ``segment``). An asset or segment in two documents raises an error."""
    unit = ["coin_id", *(["segment"] if "segment" in raw.columns else [])]
    most = raw.where(F.col("coin_id").isNotNull()).groupBy(*unit).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"))
    twice = F.raise_error(F.lit("an asset occurs in several documents: use strategy join or keyed")).cast("boolean")
    checked = F.when(F.coalesce(most.scalar(), F.lit(0)) > 1, twice).otherwise(F.lit(True))
    return document_rows(raw.where(checked), mode)


def flatten_series(raw: DataFrame, mode: str = "coalesced", strategy: str = "join") -> DataFrame:
    """The flat fact with its local wall clock."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    legs = {"join": lambda: join_legs(raw, mode=mode), "keyed": lambda: keyed_legs(raw, mode), "document": lambda: document_legs(raw, mode)}
    flat = legs[strategy]()
    return flat.withColumn("date_time", local_clock(F.col("timestamp"))).select(*FLAT_COLUMNS)
