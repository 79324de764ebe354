"""Connected components, and components of a similarity join that is given by signatures."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from series_lake.llm.staging import Staging


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return r[0], r[1]


def connected(area: Staging, edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of its component, for the nodes of ``edges`` (a, b).

    Alternates large stars (neighbours above a node move to its smallest neighbour) and small
    stars (neighbours below do) until every component is one star. A node's neighbours are
    never gathered: only their minimum is, with partial sums before the exchange.
    """
    ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = area.write(ends.where("u <> v").distinct())
    mark = _fingerprint(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("m", "u").alias("m"))
        large = both.where("v > u").join(low, F.col("u") == F.col("at")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = area.write(large)
        low = large.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("m"))
        small = large.join(low, F.col("u") == F.col("at")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = area.write(low.select(F.col("at").alias("u"), F.col("m").alias("v")).unionByName(small).distinct())
        area.drop(large, now)
        now, before = after, mark
        mark = _fingerprint(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


#: Rows of an index that are compared at once, rows in a bucket (about), rows sent as one, and the
#: largest signature whose members are compared with each other before they are dealt out.
RUN, BUCKET, SENT, SMALL = 1 << 21, 1 << 16, 1 << 10, 64


def dealt(rows: np.ndarray, buckets: int) -> pa.RecordBatch:
    """(bucket, held): rows of an index, a structured array with ``sig`` and ``node``, by parts of the
    range of signatures."""
    bucket = (((rows["sig"].view(np.uint64) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")  # 16 bits: a radix sort
    bucket, rows = bucket[order], rows[order]
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(rows)])
    sizes = np.diff(np.append(first, len(rows)))
    parts = -(-sizes // SENT)
    part = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    low = np.repeat(first, parts) + part * SENT
    high = np.minimum(low + SENT, np.repeat(first + sizes, parts))
    held = [rows[x:y].tobytes() for x, y in zip(low.tolist(), high.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[low].astype(np.int32)), pa.array(held, pa.binary())], names=["bucket", "held"])


def buckets_of(rows: float | None) -> int:
    return max(1, min(2**31 - 1, int((rows or 0) / BUCKET) + 1))


def _met(rows: np.ndarray, hubs: np.ndarray, whole: bool, near: Callable[[np.ndarray, np.ndarray], np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Members of the signatures that several nodes share: rows, hubs, whether they go with their hub,
    whether with another member. And a hub of every signature so far. Those given stay hubs."""
    rows = np.concatenate([hubs, rows])
    sig = np.ascontiguousarray(rows["sig"])
    order = np.argsort(sig)
    sig = sig[order]
    first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])[: len(sig)])
    sizes = np.diff(np.append(first, len(sig)))
    several = np.repeat(sizes > 1, sizes)
    alone, at = order[~several], order[several]
    more = [rows["e"][at]] if "e" in rows.dtype.names else []
    at = at[np.lexsort([rows["node"][at], *more, at >= len(hubs), rows["sig"][at]])]
    held = rows[at]
    keep = np.ones(len(held), dtype=bool)
    keep[1:] = (held["sig"][1:] != held["sig"][:-1]) | (held["node"][1:] != held["node"][:-1])
    held = held[keep]
    first = np.flatnonzero(np.append(True, held["sig"][1:] != held["sig"][:-1])[: len(held)])
    sizes = np.diff(np.append(first, len(held)))
    known = np.concatenate([rows[alone], held[first]])
    hub = np.repeat(held[first], sizes)
    member = held["node"] != hub["node"]
    sizes = np.add.reduceat(member.astype(np.int64), first) if len(first) else sizes
    held, hub = held[member], hub[member]
    pair = np.ones(len(held), dtype=bool) if near is None else near(hub, held)
    group = np.repeat(sizes, sizes)
    rest = (group > 1) | (not whole)
    if near is not None and whole:
        rest = group > SMALL
        few = np.flatnonzero((group > 1) & ~rest)
        sizes = sizes[(sizes > 1) & (sizes <= SMALL)]
        for i, j in pairs_within(np.append(0, np.cumsum(sizes))):
            i, j = few[i], few[j]
            close = near(held[i], held[j])
            rest[i[close]] = rest[j[close]] = True
    return held, hub, pair, rest, known


def members(kind: np.dtype, near: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows of ``dealt``, ordered by bucket: (sig, node, hub, pair, rest), and e if ``kind`` has it.

    ``near`` tells of two arrays of rows which can be linked; who can be with neither the hub nor
    another member is left out. However large a bucket is, at most about ``RUN`` rows and a hub for each
    signature are held; a bucket of several runs may name a member twice.
    """

    def out(held: list[np.ndarray], hubs: np.ndarray, whole: bool) -> tuple[pa.RecordBatch, np.ndarray]:
        rows, hub, pair, rest, known = _met(np.concatenate(held), hubs, whole, near)
        keep = pair | rest
        named = {"sig": rows["sig"], "node": rows["node"], "hub": hub["node"], "pair": pair, "rest": rest}
        named |= {"e": rows["e"]} if "e" in kind.names else {}
        return pa.RecordBatch.from_arrays([pa.array(v[keep]) for v in named.values()], names=list(named)), known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=kind)
        bucket, held, size, hubs, whole = None, [], 0, none, True
        for batch in batches:
            for own, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if held and (own != bucket or size >= RUN):
                    whole &= own != bucket
                    found, hubs = out(held, hubs, whole)
                    yield found
                    held, size = [], 0
                if own != bucket:
                    bucket, hubs, whole = own, none, True
                held.append(np.frombuffer(data.as_buffer(), dtype=kind))
                size += len(held[-1])
        if held:
            yield out(held, hubs, whole)[0]

    return run


def shared(index: DataFrame, kind: np.dtype, near: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """The members of an index that is ``dealt``."""
    told = "sig long, node long, hub long, pair boolean, rest boolean" + ", e int" * ("e" in kind.names)
    return index.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(members(kind, near), told)


TILE = 1024
TILE_KEY = ["sig", "low", "high"]


def in_tiles(rest: DataFrame, more: DataFrame) -> DataFrame:
    """The members of signatures dealt out for comparison with all others of their signature.

    A signature's members are divided into tiles of about ``TILE`` rows, and a member goes to one
    group (sig, low, high) for each tile of its signature, so groups are bounded however many
    members a signature has. In a group of two tiles only members of different tiles (``own``)
    need comparing. Rows of a group come together, in order, with the columns of ``more`` (node).
    """
    counts = rest.groupBy("sig").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("node"), F.col("tiles"))
    placed = rest.join(counts, "sig").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).drop("other", "tiles")
    return placed.join(more, "node").repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY, "node")


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups out of rows ordered by TILE_KEY, with the first row of each group
    and the number of rows at the end."""
    open_: list[pa.RecordBatch] = []
    for batch in _then_none(batches):
        if batch is not None:
            if not batch.num_rows:
                continue
            open_.append(batch)
        if not open_:
            continue
        table = pa.Table.from_batches(open_)
        keys = [table.column(c).to_numpy() for c in TILE_KEY]
        change = np.zeros(len(table), dtype=bool)
        change[0] = True
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        starts = np.flatnonzero(change)
        last = len(table) if batch is None else int(starts[-1])
        if last:
            yield table.slice(0, last), np.append(starts[starts < last], last)
        open_ = table.slice(last).combine_chunks().to_batches() if last < len(table) else []


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def pairs_within(starts: np.ndarray, chunk: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (i < j) of all pairs inside the groups that begin at ``starts``."""
    sizes = np.diff(starts)
    end = np.repeat(starts[1:], sizes)
    later = end - 1 - np.arange(len(end))
    upto = np.cumsum(later)
    low = 0
    while low < len(later):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + chunk, side="right")))
        n = later[low:high]
        i = np.repeat(np.arange(low, high), n)
        yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        low = high


def resolve(area: Staging, index: DataFrame, verifier: Callable[[DataFrame], Callable[[DataFrame], DataFrame]], across: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, label) of the graph whose links join nodes that share a signature and verify.

    ``index``: (sig, node, hub, pair, rest), see ``members``; it may have e, where e tokens of the
    node are known to be missing in every partner that shares this signature and none before it.
    ``verifier`` gets the nodes (node) that need a check and returns a function that keeps the true
    links of candidate pairs (a, b). ``across`` gets the index of the signatures that several
    components share, with a label for each node, and returns true links that join all components which
    a true link joins.

    Pairs of one component need no check, so first every member of a signature is compared with
    one hub, which merges groups of copies at linear cost. Only signatures that still hold several
    components are compared across these. Nothing is capped: in the end each pair that shares a
    signature is in one component, ruled out by a bound, or checked. Nodes without link are left out.
    """
    index = area.write(index)
    pairs = area.write(_pairs(index.where("pair")))
    members = index.where("rest").drop("hub", "pair", "rest")
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    verify = verifier(ends.unionByName(members.select("node")).distinct())
    links = area.write(verify(pairs))
    labels = area.write(connected(area, links))
    # Hubs are compared with all the others, so only these remain, where there are several.
    named = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = named.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("sig")
    rest = area.write(named.join(mixed, "sig", "left_semi"))
    more = area.write(across(rest))
    area.drop(rest, index, pairs)
    # The new links join components, so the labels are the nodes of a much smaller graph.
    own = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"of_{end}"))
    joined = more.join(own("a"), "a", "left").join(own("b"), "b", "left")
    merged = connected(area, joined.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    merged = area.write(merged.select(F.col("node").alias("label"), F.col("label").alias("final")))
    known = labels.join(merged, "label", "left").select("node", F.coalesce("final", "label").alias("label"))
    new = merged.join(labels, merged["label"] == labels["node"], "left_anti").select(F.col("label").alias("node"), F.col("final").alias("label"))
    result = area.write(known.unionByName(new))
    area.drop(links, labels, more, merged)
    return result


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
