"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is permuted by a hash of its rows and cut into blocks of the permuted order. A
source contributes whole passes over its blocks plus a last pass cut at the row where its
words come nearest to the target. The block draws of all sources are split exactly among the
output shards: a binary tree over the shards, each node dealing its counts per source to its
halves by a multivariate-hypergeometric draw. Shards then hold disjoint runs of every source's
permuted blocks and are shuffled locally.

Sources are few: their table (name, words) comes to the driver, and more than ``max_sources``
is an error. A null source is a source of its own, after all others. Null text has size 0;
rows of size 0 are never counted against a target and come once per whole pass. Repeated rows
are ordered by their place in the written copy, so exactly as many as needed are taken. Equal
input gives equal output up to which of several identical rows is meant. Empty tables give
empty results. Columns beside those named are carried along; helper columns have names that
start with ``__mix_``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from series_lake.llm.staging import BROADCAST_KEYS, Staging, staging

SPACE = r"[\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
LEVEL_BITS = 10
BOUNDARY_ROWS = 20_000


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE))).cast("bigint")


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> dict[str | None, float]:
    """Words per source: shares by weight of all words, at most ``most`` times the source's own;
    what is cut off is shared again by weight until no source is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), list(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        capped = [s for s in open_ if unit * weight[s] > most * sizes[s]]
        if not capped:
            out |= {s: unit * weight[s] for s in open_}
            break
        for s in capped:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return {s: out[s] for s in order}


def split_tree(draws: list[int], shards: int, rng: np.random.Generator) -> np.ndarray:
    """draws: block draws per source. Result [shard, source]: exact parts that add up to them."""
    out = np.zeros((shards, len(draws)), dtype=np.int64)
    open_ = [(0, shards, np.asarray(draws, dtype=np.int64))]
    while open_:
        low, high, counts = open_.pop()
        if high - low == 1:
            out[low] = counts
            continue
        mid = (low + high) // 2
        total = int(counts.sum())
        left = rng.multivariate_hypergeometric(counts, total * (mid - low) // (high - low), method="marginals") if len(counts) else counts
        open_ += [(low, mid, left), (mid, high, counts - left)]
    return out


def _digit(level: int) -> Column:
    """The level's bits of the 126-bit order (hash, then place of the row)."""
    per_key = -(-63 // LEVEL_BITS)
    column = F.col("__mix_key") if level < per_key else F.col("__mix_row")
    shift = 63 - LEVEL_BITS * (level % per_key + 1)
    return F.pmod(F.shiftright(column, shift), F.lit(1 << LEVEL_BITS)) if shift >= 0 else F.pmod(column, F.lit(1 << (LEVEL_BITS + shift)))


def _cuts(rows: DataFrame, need: dict[int, float]) -> dict[int, tuple[int, int]]:
    """Last (hash, place) taken of each source so that the words up to it come nearest ``need``.

    The place is found from sums per bucket of the order, refined level by level, so no task
    ever sorts a whole source; the last bucket (``BOUNDARY_ROWS`` rows) is sorted.
    """
    spark = rows.sparkSession
    open_ = {s: (0, 0) for s, n in need.items() if n > 0}  # source: (digits so far as one number, words below)
    per_key = -(-63 // LEVEL_BITS)
    levels = 2 * per_key
    if not open_:
        return {}

    def near(level: int) -> DataFrame:
        at = spark.createDataFrame([(s, str(d), b, need[s]) for s, (d, b) in open_.items()], "__mix_at int, path string, below long, need double")
        path = F.concat_ws("/", F.lit("0"), *[_digit(i) for i in range(level)])
        return rows.join(F.broadcast(at), (rows["__mix_source"] == at["__mix_at"]) & (path == at["path"]))

    paths = {s: "0" for s in open_}
    open_ = {s: (paths[s], 0) for s in open_}
    for level in range(levels):
        by_digit = near(level).groupBy("__mix_source", "need", "below", _digit(level).alias("digit")).agg(F.sum("__mix_size").alias("words"), F.count("*").alias("n"))
        up_to = Window.partitionBy("__mix_source").orderBy("digit")
        reached = by_digit.withColumn("upto", F.col("below") + F.sum("words").over(up_to)).withColumn("last", F.max("digit").over(Window.partitionBy("__mix_source")))
        first = reached.where((F.col("upto") >= F.col("need")) | (F.col("digit") == F.col("last"))).withColumn("nth", F.row_number().over(up_to)).where("nth = 1")
        found = first.select("__mix_source", "digit", (F.col("upto") - F.col("words")).alias("below"), "n").collect()  # one row per source
        open_ = {r[0]: (f"{open_[r[0]][0]}/{r['digit']}", r["below"]) for r in found}
        if max((r["n"] for r in found), default=0) <= BOUNDARY_ROWS:
            levels = level + 1
            break
    order = Window.partitionBy("__mix_source").orderBy("__mix_key", "__mix_row")
    ranked = near(levels).withColumn("upto", F.col("below") + F.sum("__mix_size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    before, after = F.abs(F.col("upto") - F.col("__mix_size") - F.col("need")), F.abs(F.col("upto") - F.col("need"))
    # Take a row while it brings the sum nearer; sums only grow, so those rows are a prefix.
    taken = ranked.where(after < before).groupBy("__mix_source").agg(F.max(F.struct("__mix_key", "__mix_row")).alias("cut"))
    cuts = {r[0]: (r["cut"][0], r["cut"][1]) for r in taken.collect()}
    missing = [s for s in open_ if s not in cuts]
    if missing:  # nothing of the boundary bucket: the cut is the last row before it
        first_rows = near(levels).groupBy("__mix_source").agg(F.min(F.struct("__mix_key", "__mix_row")).alias("first"))
        for r in first_rows.collect():
            if r[0] in missing:
                cuts[r[0]] = (r["first"][0], r["first"][1] - 1)
    return cuts


def _prepare(area: Staging, docs: DataFrame, carry: list[str], id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    key = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(source_col), F.col(text_col)), 1)
    return area.write(
        docs.select(
            *[F.col(c) for c in carry],
            F.col(source_col).cast("string").alias("__mix_name"),
            word_count(F.col(text_col)).alias("__mix_size"),
            key.alias("__mix_key"),
            F.monotonically_increasing_id().alias("__mix_row"),
        ),
        keep=True,
    )


def _plan(rows: DataFrame, weights: tuple[int, ...], most: int, max_sources: int) -> tuple[DataFrame, list[dict]]:
    """Rows with the plan of their source, and the plan per source in order."""
    spark = rows.sparkSession
    summed = rows.groupBy("__mix_name").agg(F.sum("__mix_size").alias("words")).limit(max_sources + 1).collect()
    if len(summed) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    sizes = {r["__mix_name"]: r["words"] for r in summed}
    wanted = targets(sizes, weights, most)
    plan = []
    for i, (name, target) in enumerate(wanted.items()):
        passes = min(most, int(target // sizes[name])) if sizes[name] else 0
        plan.append({"i": i, "name": name, "size": sizes[name], "target": target, "passes": passes, "rest": 0.0 if passes == most else target - passes * sizes[name]})
    names = spark.createDataFrame([(p["i"], p["name"]) for p in plan], "__mix_source int, __mix_of string")
    numbered = rows.join(F.broadcast(names), rows["__mix_name"].eqNullSafe(names["__mix_of"])).drop("__mix_of")
    cuts = _cuts(numbered, {p["i"]: p["rest"] for p in plan})
    for p in plan:
        p["cut_key"], p["cut_row"] = cuts.get(p["i"], (-1, -1))
    return numbered, plan


def _copies(numbered: DataFrame, plan: list[dict]) -> DataFrame:
    """Adds source_size, target, passes and copies to the rows."""
    spark = numbered.sparkSession
    table = spark.createDataFrame(
        [(p["i"], p["size"], p["target"], p["passes"], p["cut_key"], p["cut_row"]) for p in plan],
        "__mix_at int, __mix_total long, __mix_target double, __mix_passes int, __mix_cut_key long, __mix_cut_row long",
    )
    joined = numbered.join(F.broadcast(table), F.col("__mix_source") == F.col("__mix_at")).drop("__mix_at")
    inside = (F.col("__mix_key") < F.col("__mix_cut_key")) | ((F.col("__mix_key") == F.col("__mix_cut_key")) & (F.col("__mix_row") <= F.col("__mix_cut_row")))
    return joined.withColumn("__mix_copies", F.col("__mix_passes") + inside.cast("int"))


def _dealt(numbered: DataFrame, plan: list[dict], seed: int, shard_words: int, blocks_per_shard: int) -> DataFrame:
    """A row per copy, with its ``mix_shard``: the draws dealt by the tree, each shard shuffled."""
    spark = numbered.sparkSession
    total = sum(p["target"] for p in plan)
    shards = max(1, math.ceil(total / shard_words))
    block_words = max(1.0, total / (shards * blocks_per_shard))
    draws = []
    for p in plan:
        p["blocks"] = max(1, math.ceil(p["size"] / block_words))
        # Blocks of the last pass: up to and with the one that holds the cut.
        p["part"] = min(p["blocks"], int(p["cut_key"] / 2**63 * p["blocks"]) + 1) if p["cut_key"] >= 0 else 0
        draws.append(p["passes"] * p["blocks"] + p["part"])
    dealt = split_tree(draws, shards, np.random.default_rng(seed))
    runs, rng = [], np.random.default_rng(seed + 1)
    for p in plan:
        steps = []
        for _ in range(p["passes"]):
            a = int(rng.integers(1, p["blocks"] + 1))
            while math.gcd(a, p["blocks"]) != 1:
                a = a % p["blocks"] + 1
            steps.append((a, int(rng.integers(0, p["blocks"]))))
        steps.append((1, 0))  # the last pass is cut along the order itself
        starts = np.concatenate([[0], np.cumsum(dealt[:, p["i"]])])
        runs += [(p["i"], j, int(starts[j]), int(starts[j + 1])) for j in range(shards) if starts[j + 1] > starts[j]]
        p["steps"] = steps
    deal = spark.createDataFrame(runs, "__mix_at int, mix_shard int, low long, high long")
    deal = deal.select("__mix_at", "mix_shard", F.explode(F.sequence("low", F.col("high") - 1)).alias("__mix_draw"))
    how = spark.createDataFrame([(p["i"], p["blocks"], [s[0] for s in p["steps"]], [s[1] for s in p["steps"]]) for p in plan], "__mix_p int, __mix_blocks long, __mix_a array<long>, __mix_c array<long>")
    rows = _copies(numbered, plan).where("__mix_copies > 0")
    rows = rows.join(F.broadcast(how), F.col("__mix_source") == F.col("__mix_p")).withColumn("__mix_pass", F.explode(F.sequence(F.lit(0), F.col("__mix_copies") - 1)))
    block = F.floor(F.col("__mix_key").cast("double") / F.lit(2.0**63) * F.col("__mix_blocks"))
    block = F.least(block, F.col("__mix_blocks") - 1)
    placed = F.pmod(F.get("__mix_a", F.col("__mix_pass")) * block + F.get("__mix_c", F.col("__mix_pass")), F.col("__mix_blocks"))
    rows = rows.withColumn("__mix_draw", F.col("__mix_pass") * F.col("__mix_blocks") + placed)
    # Some tens of draws per shard: few enough, as counted above, to go to the texts, or else the texts move.
    side = F.broadcast(deal) if sum(draws) <= BROADCAST_KEYS else deal
    rows = rows.join(side, (rows["__mix_source"] == deal["__mix_at"]) & (rows["__mix_draw"] == deal["__mix_draw"]), "left")
    return rows.repartitionById(shards, F.col("mix_shard")).sortWithinPartitions("mix_shard", F.xxhash64(F.lit(seed + 2), "__mix_pass", "__mix_key", "__mix_row"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: int = 11, shard_words: int = 4_000_000, blocks_per_shard: int = 64, max_sources: int = 100_000) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, a row per copy, plus ``mix_shard``; one
    partition per shard, in shuffled order inside it."""
    with staging(docs.sparkSession, "mix") as area:
        rows = _prepare(area, docs, docs.columns, id_col, text_col, source_col, seed)
        return _dealt(*_plan(rows, weights, most, max_sources), seed, shard_words, blocks_per_shard).select(*docs.columns, "mix_shard")


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: int = 11, shard_words: int = 4_000_000, blocks_per_shard: int = 64, max_sources: int = 100_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, copies, taken. The copies
    are counted in the mixed corpus, whose shards are written with all columns of ``docs``."""
    spark = docs.sparkSession
    with staging(spark, "mix") as area:
        rows = _prepare(area, docs, docs.columns, id_col, text_col, source_col, seed)
        numbered, plan = _plan(rows, weights, most, max_sources)
        shards = area.write(_dealt(numbered, plan, seed, shard_words, blocks_per_shard).select(*docs.columns, "mix_shard", "__mix_row"))
        came = area.write(shards.groupBy(F.col("__mix_row").alias("__mix_at")).agg(F.count("*").alias("__mix_came")), keep=True)
        area.drop(shards)
        table = spark.createDataFrame([(p["i"], p["size"], p["target"]) for p in plan], "__mix_p int, __mix_total long, __mix_target double")
        told = numbered.join(F.broadcast(table), F.col("__mix_source") == F.col("__mix_p")).join(came, F.col("__mix_row") == F.col("__mix_at"), "left")
        copies = F.coalesce("__mix_came", F.lit(0)).cast("int")
        return told.select(
            F.col(id_col).alias("doc_id"), F.col("__mix_size").alias("size"), F.col("__mix_total").alias("source_size"), F.col("__mix_target").alias("target"),
            copies.alias("copies"), (copies * F.col("__mix_size")).alias("taken"),
        )
