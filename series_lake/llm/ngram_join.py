"""N-gram Jaccard join with token-combination prefixes.

A document is the set of its word shingles (tokens). Two sets with Jaccard >= t differ in few
tokens, so in a common order of all tokens they share tokens among the first ones: a set of n
tokens has at most ``slack`` = n - ceil(t n) tokens that its partner lacks. Tokens fall into
classes by frequency. A rare token is a signature of its own; of more frequent classes only
combinations of 2 or 3 tokens are. A prefix that holds ``k`` tokens of a class of k-combinations
survives the loss of all but k - 1 of them, so prefixes are extended until the sum of
max(0, held - k + 1) over the classes exceeds ``slack``; then partners share a signature
whatever the differences are. To keep combinations few, the frequent classes are divided by
token hash into classes of a few tokens per prefix each, more for larger sets.

Sets are compared within bands of size (powers of two; a set close to the next band joins it
too), and frequencies are those within the band. Rare tokens come first in the order, those in
the lower ``counted`` part of the hash range before all others. That part is counted over all
documents. Most sets fill their prefix with rare tokens of that part; only for sets that do not
the other tokens are counted as well. Of the tokens that more than RARE sets hold, at most the
``heavy`` most frequent of each count form the frequent classes. Any order and any classes
give exact results; they decide only the cost.

Candidates are compared by a bound from small histograms (the L1 distance of two histograms
never exceeds the number of tokens that differ), finer ones for large sets, and then exactly, set
against set. Tokens are
64-bit hashes. Equal sets are one node, so copies are never expanded into pairs.

Null text and texts without words have an empty set and are linked with nothing; their
component is their own id. Repeated rows are copies. A row without id gets the component's
smallest id, or null. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from series_lake.llm.components import buckets_of, dealt, in_tiles, pairs_within, resolve, shared, whole_groups
from series_lake.llm.hashing import Words, distinct, mixed, shingle_sets
from series_lake.llm.staging import Staging, semi_by_key, writing, staging

RARE, FREQUENT = 32, 1024
HEAVY = 1 << 17
BUCKETS = 128
ENTRY = np.dtype([("sig", "<i8"), ("node", "<i8"), ("e", "<i4")])
SMALL_BAND = 6  # sets below 2**6 tokens: all their tokens are counted


@dataclass(frozen=True)
class Join:
    """Jaccard >= num / den over shingles of ``width`` words."""

    width: int = 5
    num: int = 80
    den: int = 100
    lower: bool = True

    def slack(self, n: int) -> int:
        return n - -(-n * self.num // self.den)

    def alone(self, n: int) -> bool:
        """Whether a set of n tokens can be linked with equal sets only."""
        return n * self.den < self.num * (n + 1)

    def bands(self, n: int) -> list[int]:
        band = n.bit_length() - 1
        return [band, band + 1] if n * self.den // self.num >= 1 << (band + 1) else [band]

    def parts(self, band: int) -> int:
        """Classes into which the tokens of each frequency are divided; 0: all tokens are singles.

        Losing 2 + 1 tokens per class must leave more than ``slack`` of the smallest set.
        """
        least = 1 << band
        return min(max(1, self.slack(least)), (-(-least * self.num // self.den) - 1) // 3)

    @property
    def counted(self) -> np.uint64:
        return np.uint64(min(2**64 - 1, int(1.6 * (1 - self.num / self.den) * 2**64)))


def _in_band(tokens: np.ndarray, band: int) -> np.ndarray:
    return mixed(tokens ^ np.uint64(0xD6E8FEB86659FD93 * (band + 1) % 2**64))


def _node(tokens: np.ndarray) -> int:
    """64 bits that name a set; 0 is left to sets without tokens."""
    total = (int(mixed(tokens).sum(dtype=np.uint64)) + len(tokens)) % 2**64
    return int(mixed(np.array([total], dtype=np.uint64)).view(np.int64)[0]) or 1


def _fresh(batches: Iterator[pa.RecordBatch], join: Join) -> Iterator[tuple[int, np.ndarray]]:
    """(node, tokens) of the sets that may have other partners than equal ones, once per task."""
    words, seen = Words(join.lower), set()
    for batch in batches:
        for _, tokens in shingle_sets(batch.column(0), words, join.width):
            if len(tokens) and not join.alone(len(tokens)) and (node := _node(tokens)) not in seen:
                seen.add(node)
                yield node, tokens


def _fine(tokens: np.ndarray) -> bytes | None:
    """Histogram of a large set with about eight tokens per bin; its halves add up to a coarser one."""
    if len(tokens) <= 8 * BUCKETS:
        return None
    bins = 1 << (len(tokens) // 8).bit_length()
    counts = np.bincount((tokens & np.uint64(bins - 1)).astype(np.int64), minlength=bins)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _described(join: Join):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(join.lower)
        for batch in batches:
            n, nodes, sketches, fine = [], [], [], []
            for _, tokens in shingle_sets(batch.column(1), words, join.width):
                n.append(len(tokens))
                nodes.append(_node(tokens) if len(tokens) else None)
                counts = np.bincount((tokens & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
                sketches.append(None if join.alone(len(tokens)) else np.minimum(counts, 255).astype(np.uint8).tobytes())
                fine.append(_fine(tokens))
            columns = [pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sketches, pa.binary()), pa.array(fine, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n", "node", "sketch", "fine"])

    return run


def _slot(tokens: np.ndarray) -> np.ndarray:
    return tokens.astype(np.uint32).view(np.int32)


@dataclass(frozen=True)
class Classes:
    """The frequent tokens: their slots, sorted, and the size of their combinations."""

    slots: np.ndarray
    sizes: np.ndarray

    def of(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.slots):
            return np.ones(len(tokens), dtype=np.int64)
        own = _slot(tokens)
        found = np.minimum(np.searchsorted(self.slots, own), len(self.slots) - 1)
        return np.where(self.slots[found] == own, self.sizes[found], 1)


def _known(own: np.ndarray, band: int, join: Join) -> int:
    """How many of the sorted tokens are in the counted part."""
    return len(own) if band < SMALL_BAND else int(np.searchsorted(own, join.counted))


def _tallied(join: Join, classes: Classes | None):
    """Slots (32 bits) with counts: of the tokens in the counted part; given ``classes``, of the
    other tokens of the sets that have too few rare ones in that part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            slots, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(slots), pa.array(n.astype(np.int32))], names=["slot", "n"])

        for _, tokens in _fresh(batches, join):
            for band in join.bands(len(tokens)):
                own = np.sort(_in_band(tokens, band))
                known = _known(own, band, join)
                if classes is None:
                    held.append(_slot(own[:known]))
                elif (classes.of(own[:known]) == 1).sum() <= join.slack(len(own)):
                    held.append(_slot(own[known:]))
                else:
                    continue
                size += len(held[-1])
            if size > 1 << 20:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return run


def signatures(tokens: np.ndarray, join: Join, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set, and how many of its tokens a partner lacks for certain if this is the
    first signature they share.

    That number is a rare token's place among the rare ones, which come first. Whoever shares a
    later signature has a prefix that holds all its rare tokens, so then all of them are missing.
    """
    out, missing, slack = [], [], join.slack(len(tokens))
    for band in join.bands(len(tokens)):
        own, parts = np.sort(_in_band(tokens, band)), join.parts(band)
        few = 2 * slack + 8
        if parts and (classes.of(own[:few]) == 1).sum() <= slack:
            few, k_of = len(own), classes.of(own)
            rare = own[k_of == 1][: slack + 1]  # sorted, so those of the counted part are first
        else:
            head = own[:few]
            rare = (head[classes.of(head) == 1] if parts else head)[: slack + 1]
        out.append(rare)
        missing.append(np.arange(len(rare)))
        units = len(rare)
        for k in (2, 3):
            if units > slack:
                break
            held: dict[int, list[int]] = {}
            for token in own[k_of == k].tolist():
                group = held.setdefault((token >> 32) % parts, [])
                group.append(token)
                units += len(group) >= k
                if units > slack:
                    break
            combos = [c for group in held.values() for c in combinations(group, k)]
            if combos:
                table = np.array(combos, dtype=np.uint64)
                joined = np.full(len(table), k, dtype=np.uint64)
                for j in range(k):
                    joined = mixed(joined * np.uint64(0x9E3779B97F4A7C15) + table[:, j])
                out.append(joined)
                missing.append(np.full(len(joined), len(rare)))
    return np.concatenate(out), np.concatenate(missing)


def _indexed(join: Join, classes: Classes, buckets: int):
    """The index, dealt by signature: it is many short rows, which are cheap in arrays only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for node, tokens in _fresh(batches, join):
            sigs, missing = signatures(tokens, join, classes)
            rows = np.empty(len(sigs), dtype=ENTRY)
            rows["sig"], rows["node"], rows["e"] = sigs.view(np.int64), node, missing
            held.append(rows)
            size += len(rows)
            if size > 1 << 20:
                yield dealt(np.concatenate(held), buckets)
                held, size = [], 0
        if held:
            yield dealt(np.concatenate(held), buckets)

    return run


def _apart(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """L1 distances of histograms, which never exceed the numbers of tokens that differ."""
    a, b = (np.frombuffer(b"".join(v), dtype=np.uint8).reshape(-1, BUCKETS).astype(np.int16) for v in (x, y))
    return np.abs(a - b).sum(axis=1, dtype=np.int64)


def _close(join: Join):
    """Pairs whose histograms do not rule the link out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
                apart = _apart(batch.column(4).to_pylist(), batch.column(5).to_pylist())
                yield batch.select([0, 1]).filter(pa.array(apart * (join.den + join.num) <= total * (join.den - join.num)))

    return run


def _close_finely(join: Join):
    """Pairs of large sets whose finer histograms do not rule the link out; other pairs pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n_a, n_b, x, y in zip(*[batch.column(i).to_pylist() for i in (2, 3)], batch.column(4), batch.column(5), strict=True):
                apart = 0
                if x.is_valid and y.is_valid:
                    a, b = (np.frombuffer(v.as_buffer(), dtype=np.uint8).astype(np.int32) for v in (x, y))
                    bins = min(len(a), len(b))
                    apart = int(np.abs(a.reshape(-1, bins).sum(axis=0) - b.reshape(-1, bins).sum(axis=0)).sum())
                keep.append(apart * (join.den + join.num) <= (n_a + n_b) * (join.den - join.num))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _close_within(join: Join):
    """Pairs of different components in groups of rows (see ``in_tiles``) that neither sizes nor
    missing tokens nor histograms rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches):
            node, label, own, low, high, e, n = (table.column(c).to_numpy().astype(np.int64) for c in ("node", "label", "own", "low", "high", "e", "n"))
            sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, BUCKETS).astype(np.int16)
            for i, j in pairs_within(starts):
                total = n[i] + n[j]
                near = (label[i] != label[j]) & ((low[i] == high[i]) | (own[i] != own[j]))
                near &= np.minimum(n[i], n[j]) * join.den >= np.maximum(n[i], n[j]) * join.num
                near &= (e[i] + e[j]) * (join.den + join.num) <= total * (join.den - join.num)
                i, j, total = i[near], j[near], total[near]
                for at in range(0, len(i), 1 << 14):
                    x, y = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
                    apart = np.abs(sketches[x] - sketches[y]).sum(axis=1, dtype=np.int64)
                    keep = apart * (join.den + join.num) <= total[at : at + (1 << 14)] * (join.den - join.num)
                    if keep.any():
                        ends = np.unique(np.sort(np.stack([node[x[keep]], node[y[keep]]], axis=1), axis=1), axis=0)
                        yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    return run


def _as_sets(join: Join):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, tokens in _fresh(batches, join):
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([tokens.tobytes()], pa.binary())], names=["node", "tokens"])

    return run


def _linked(join: Join):
    """Pairs whose sets are similar enough, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                common = len(a) + len(b) - len(distinct(np.concatenate([a, b])))
                keep.append(join.den * common >= join.num * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _frequent(texts: DataFrame, join: Join, rare: int, frequent: int, heavy: int) -> Classes:
    def top(known: Classes | None) -> tuple[np.ndarray, np.ndarray]:
        counts = texts.mapInArrow(_tallied(join, known), "slot int, n int").groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") > rare)
        with writing(texts.sparkSession):
            rows = counts.orderBy(F.desc("n"), "slot").limit(heavy).toArrow()  # at most ``heavy`` rows
        return rows.column("slot").to_numpy(), np.where(rows.column("n").to_numpy() > frequent, 3, 2)

    def merged(slots: np.ndarray, sizes: np.ndarray) -> Classes:
        order = np.lexsort((-sizes, slots))
        first = np.append(True, np.diff(slots[order]) != 0)[: len(order)]
        return Classes(slots[order][first], sizes[order][first])

    part = top(None)
    other = top(merged(*part))
    return merged(np.concatenate([part[0], other[0]]), np.concatenate([part[1], other[1]]))


def components(area: Staging, docs: DataFrame, join: Join, id_col: str, text_col: str, rare: int = RARE, frequent: int = FREQUENT, heavy: int = HEAVY) -> tuple[DataFrame, DataFrame]:
    """Staged (doc_id, n, node, sketch) per row, and (node, label) of the linked nodes."""
    text = F.col(text_col).cast("string").alias("text")
    texts = docs.where(F.col(text_col).isNotNull()).select(text)
    id_type = docs.select(F.col(id_col).alias("doc_id")).schema[0].dataType
    read = docs.select(F.col(id_col).alias("doc_id"), text)
    schema = read.select("doc_id").schema.add("n", "long").add("node", "long").add("sketch", "binary").add("fine", "binary")
    rows = area.write(read.mapInArrow(_described(join), schema), keep=True)
    classes = _frequent(texts, join, rare, frequent, heavy)
    expected = rows.agg(F.sum(F.col("n") * (1 - join.num / join.den) + 1)).first()[0]
    index = shared(texts.mapInArrow(_indexed(join, classes, buckets_of(expected)), "bucket int, held binary"), ENTRY)
    nodes = area.write(rows.where("sketch is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("fine").alias("fine"), F.min("doc_id").alias("doc_id")))

    def exact(pairs: DataFrame) -> DataFrame:
        a, b = (nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("fine").alias(f"fine_{x}")) for x in "ab")
        finer = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "fine_a", "fine_b")
        close = area.write(finer.mapInArrow(_close_finely(join), "a long, b long"))
        wanted = close.select(F.col("a").alias("node")).unionByName(close.select(F.col("b").alias("node"))).distinct()
        holders = area.write(wanted.join(nodes.select("node", "doc_id"), "node"))
        holding = semi_by_key(docs.select(F.col(id_col).cast(id_type).alias("doc_id"), text), holders.select("doc_id").distinct(), ["doc_id"])
        sets = holding.select("text").mapInArrow(_as_sets(join), "node long, tokens binary")
        sets = area.write(semi_by_key(sets, holders.select("node"), ["node"]).dropDuplicates(["node"]))
        both = close.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
        links = area.write(both.select("a", "b", "x", "y").mapInArrow(_linked(join), "a long, b long"))
        area.drop(close, holders, sets)
        return links

    def verify(pairs: DataFrame) -> DataFrame:
        a = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
        b = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
        sized = pairs.join(a, "a").join(b, "b").where(F.least("n_a", "n_b") * join.den >= F.greatest("n_a", "n_b") * join.num)
        return exact(sized.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(_close(join), "a long, b long"))

    def across(rest: DataFrame) -> DataFrame:
        dealt = in_tiles(rest, nodes.select("node", "n", "sketch"))
        return exact(dealt.mapInArrow(_close_within(join), "a long, b long").distinct())

    labels = resolve(area, index, lambda _: verify, across)
    return rows, labels


def near_duplicates(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text_col: str = "text", **classes: int) -> DataFrame:  # noqa: B008
    """doc_id, n_shingles, component_id: a row per row of ``docs``."""
    with staging(docs.sparkSession, "ngram-join") as area:
        rows, labels = components(area, docs, join, id_col, text_col, **classes)
        own = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
        named = own.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
        of_node = area.write(named.join(smallest, "label").select("node", "component_id"), keep=True)
        joined = rows.join(of_node, "node", "left")
        return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:  # noqa: B008
    """The rows of ``docs`` but for one of each component: the smallest id (null last), and of rows
    with one id the smallest hash of the text. Rows without words have no component and stay;
    rows that repeat id and text are one."""
    text = F.col(text_col).cast("string")
    parts = {"__ngram_a": F.col(id_col).isNull(), "__ngram_b": F.col(id_col), "__ngram_c": F.xxhash64(text), "__ngram_d": F.hash(text)}
    keyed = docs.withColumns(parts)
    found = near_duplicates(docs.select(F.struct(*[v.alias(k) for k, v in parts.items()]).alias("key"), text.alias("text")), join, "key", "text")
    stays = found.where(F.col("component_id") == F.col("doc_id")).select(*[F.col(f"doc_id.{k}").alias(f"{k}s") for k in parts]).distinct()
    same = [keyed[k].eqNullSafe(stays[f"{k}s"]) for k in parts]
    kept = keyed.join(stays, same[0] & same[1] & same[2] & same[3], "left_semi")
    return kept.dropDuplicates(list(parts)).select(*docs.columns)
