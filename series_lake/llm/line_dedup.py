"""Fuzzy line de-duplication by MinHash.

A line is the set of its character shingles. One-permutation MinHash gives each distinct line
a signature; its bands are the keys under which lines meet. Of pairs that meet, numbers and bitmaps
of the shingles rule out most that are not similar; the others are compared exactly, shingle set
against shingle set, so only their texts are sent. A distributed union-find joins similar lines
into components. Of each component, equal lines included, only the first line stays: the one
with the smallest document id, then the first in the document.

With ``bands`` bands of ``rows`` values, lines of similarity s meet with probability
1 - (1 - s^rows)^bands: 0.997 at 0.8, 0.9995 at 0.85 and above 0.99999 at 0.9, for ``Lines()``.

Lines end at line feeds. Lines of white space, and lines shorter than ``least`` characters, are
not compared and always stay; by default only the former. A line shorter than a shingle
is one whole shingle: only its equals are like it. Null text stays null and has no lines. Rows that repeat
id and text count as one document; rows with the same id and other texts as several. A row
without id comes last. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType

from series_lake.llm.components import TILE_KEY, buckets_of, dealt, in_tiles, pairs_within, resolve, shared, whole_groups
from series_lake.llm.hashing import distinct, mixed
from series_lake.llm.staging import BROADCAST_KEYS, Staging, semi_by_key, staging

PART = 1 << 17
TILE_COLUMNS = 4096
SMALL_GROUP = 12
HEAVY = 4096
LEAST_BITS, MOST_BITS = 64, 1 << 16
NONE = np.uint64(2**64 - 1)
ENTRY = np.dtype([("sig", "<i8"), ("node", "<i8"), ("n", "<i4")])


@dataclass(frozen=True)
class Lines:
    """Similar: Jaccard >= num / den over shingles of ``width`` characters."""

    width: int = 5
    num: int = 80
    den: int = 100
    bands: int = 11
    rows: int = 4
    least: int = 1


#: Every line with a character that is not white space takes part, and one changed character in a
#: line of 50 or more leaves it similar.
EVERY_LINE = Lines()


def _rolled(codes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` characters, by doubling."""
    base = np.uint64(0x9E3779B97F4A7C15)
    size, power, table = 1, base, codes.astype(np.uint64) + np.uint64(1)
    out, done = None, 0
    while True:
        if width & size:
            n = len(codes) - done - size + 1
            out = table[:n].copy() if out is None else out[:n] * power + table[done : done + n]
            done += size
        if size * 2 > width:
            return mixed(out)
        n = len(codes) - 2 * size + 1
        table = table[:n] * power + table[size : size + n]
        power, size = power * power, size * 2


def _sets(lines_: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of many lines, hashed together."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(lines_):
        end, size = at, 0
        while end < len(lines_) and (end == at or size + len(lines_[end]) < PART):
            size += len(lines_[end]) + 1
            end += 1
        sizes = np.array([len(t) for t in lines_[at:end]])
        starts = np.cumsum(sizes + 1) - sizes - 1
        with np.errstate(over="ignore"):
            one = _rolled(_codes("\n".join(lines_[at:end])), width)
        out += [distinct(one[s : s + n - width + 1]) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
        at = end
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@cache
def _orders(bins: int) -> np.ndarray:
    """[bin, step]: the other bins in the order in which an empty one looks for a value."""
    rng = np.random.default_rng(bins)
    return np.array([rng.permutation([b for b in range(bins) if b != own]) for own in range(bins)])


def _weights(sizes: np.ndarray) -> np.ndarray:
    """An odd number for each place in a line, without a pattern that other orders could repeat."""
    return mixed(np.arange(1, int(sizes.max(initial=0)) + 1, dtype=np.uint64)) | np.uint64(1)


def short_names(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit names of lines shorter than a shingle: each is one whole shingle."""
    n = ends - starts
    first = np.cumsum(n) - n
    place = np.arange(int(n.sum())) - np.repeat(first, n)
    with np.errstate(over="ignore"):
        h = mixed(codes[place + np.repeat(starts, n)].astype(np.uint64) + np.uint64(1))
        total = np.add.reduceat(h * _weights(n)[place], first) if len(n) else np.zeros(0, np.uint64)
        return mixed(mixed(total) ^ n.astype(np.uint64))


def _bitmaps(h: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Of lines with ``n`` shingle hashes each, repeats included: a bit for each hash modulo the number of bits,
    which is a power of two from 1.5 n on. Halves of a bitmap, united, are one of half the bits."""
    bits = 1 << np.ceil(np.log2(np.clip(1.5 * n, LEAST_BITS, MOST_BITS))).astype(np.int64)
    ends = np.cumsum(bits)
    held = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=bool)
    held[np.repeat(ends - bits, n) + (h & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64)] = True
    packed = np.packbits(held, bitorder="little").tobytes()
    return [packed[low:high] for low, high in zip(((ends - bits) // 8).tolist(), (ends // 8).tolist(), strict=True)]


def _counts(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many different shingles (by 52 bits) each of the lines with ``n`` shingle hashes has."""
    out, first = np.zeros(len(n), dtype=np.int64), np.cumsum(n) - n
    for low in range(0, len(n), 4096):
        own, at = n[low : low + 4096], int(first[low])
        line = np.repeat(np.arange(len(own), dtype=np.uint64) << np.uint64(52), own)
        keys = np.sort(line | (h[at : at + len(line)] >> np.uint64(12)))  # each line keeps its place
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        out[low : low + 4096] = np.add.reduceat(new, first[low : low + 4096] - at, dtype=np.int64)
    return out


def signatures(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, lines: Lines) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of lines [start, end) in a run of characters: a 64-bit name each, [line, band] keys, and a bitmap each."""
    return described(codes, starts, ends, lines)[:3]


def described(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, lines: Lines) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """``signatures``, and how many different shingles each line has."""
    bins = lines.bands * lines.rows
    with np.errstate(over="ignore"):
        one = _rolled(codes, lines.width)
        sizes = ends - starts
        n = sizes - lines.width + 1
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        h = one[place + np.repeat(starts, n)]
        bin_ = ((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        least = np.full(len(starts) * bins, NONE, dtype=np.uint64)
        np.minimum.at(least, np.repeat(np.arange(len(starts)) * bins, n) + bin_.astype(np.int64), h * np.uint64(0xBF58476D1CE4E5B9))
        least = least.reshape(len(starts), bins)
        # Empty bins borrow from the first that is not, each in an order of its own: the bins of
        # one band of a short line then hold several of its shingles.
        some = np.flatnonzero((least == NONE).any(axis=1))
        if len(some):
            own = least[some]
            full = own.copy()
            at, b = np.nonzero(own == NONE)
            for step in _orders(bins).T:
                value = own[at, step[b]]
                found = value != NONE
                full[at[found], b[found]] = mixed(value[found] + np.uint64(1))
                at, b = at[~found], b[~found]
                if not len(at):
                    break
            least[some] = full
        keys = np.zeros((len(starts), lines.bands), dtype=np.uint64) + np.arange(1, lines.bands + 1, dtype=np.uint64)
        for r in range(lines.rows):
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + least[:, r :: lines.rows])
        # Order-dependent sum of all shingles: names equal lines alike, others apart.
        total = np.add.reduceat(h * _weights(n)[place], first) if len(n) else np.zeros(0, np.uint64)
        names = mixed(total + sizes.astype(np.uint64))
    return names, keys, _bitmaps(h, n), _counts(h, n)


def _named(lines: Lines):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()

        def found(texts: list[str]) -> Iterator[tuple[list[int | None], list[int], bytes, list[bytes], list[int]]]:
            """Per text: its lines' names (null: not compared), the names of those new to the task, their
            band keys, their bitmaps and how many different shingles they have."""
            codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            breaks = np.flatnonzero(codes == 0x0A)
            starts, ends = np.append(0, breaks + 1), np.append(breaks, len(codes))
            filled = np.append(0, np.cumsum(~((codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D)))))
            told = np.flatnonzero((ends - starts >= lines.least) & (filled[ends] > filled[starts]))
            long_ = ends[told] - starts[told] >= lines.width
            names = np.zeros(len(told), dtype=np.uint64)
            keys, bitmaps, sizes = np.zeros((0, lines.bands), dtype=np.uint64), [], np.zeros(0, dtype=np.int64)
            if long_.any():
                names[long_], keys, bitmaps, sizes = described(codes, starts[told[long_]], ends[told[long_]], lines)
            names[~long_] = short_names(codes, starts[told[~long_]], ends[told[~long_]])
            names, row, long_, sizes = names.view(np.int64).tolist(), (np.cumsum(long_) - 1).tolist(), long_.tolist(), sizes.tolist()
            number, first = 0, 0
            for text in texts:
                n = text.count("\n") + 1
                own: list[int | None] = [None] * n
                fresh, new = [], []
                while number < len(told) and told[number] < first + n:
                    own[int(told[number] - first)] = names[number]
                    # What is shorter than a shingle is like equal lines only: these have its name.
                    if long_[number] and names[number] not in seen:
                        seen.add(names[number])
                        fresh.append(names[number])
                        new.append(row[number])
                    number += 1
                first += n
                yield own, fresh, keys[new].tobytes(), [bitmaps[k] for k in new], [sizes[k] for k in new]

        for batch in batches:
            run_, size, rows = [], 0, []
            for text in batch.column("text"):
                run_.append(text.as_py())
                size += len(run_[-1])
                if size >= PART:
                    rows += found(run_)
                    run_, size = [], 0
            if run_:
                rows += found(run_)
            names, nodes, sigs, bits, most = zip(*rows, strict=True) if rows else ((), (), (), (), ())
            kept = [c for c in batch.schema.names if c != "text"]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            made = pa.array(names, pa.list_(pa.int64())), pa.array(nodes, pa.list_(pa.int64())), pa.array(sigs, pa.binary()), pa.array(bits, pa.list_(pa.binary())), pa.array(most, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*columns, *made], names=[*kept, "names", "nodes", "sigs", "bits", "most"])

    return run


def _indexed(lines: Lines, buckets: int):
    """The index of the lines new to each task, dealt by signature: it is very many short rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            nodes, most = batch.column("nodes").flatten().to_numpy(), batch.column("most").flatten().to_numpy()
            rows = np.empty((len(nodes), lines.bands), dtype=ENTRY)
            rows["sig"] = np.frombuffer(b"".join(batch.column("sigs").to_pylist()), dtype=np.int64).reshape(rows.shape)
            rows["node"], rows["n"] = nodes[:, None], most[:, None]
            held.append(rows.ravel())
            size += rows.size
            if size > 1 << 20:
                yield dealt(np.concatenate(held), buckets)
                held, size = [], 0
        if size:
            yield dealt(np.concatenate(held), buckets)

    return run


def _alike_in_size(lines: Lines):
    """Whether rows of the index have sets whose sizes let them be similar."""

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = a["n"].astype(np.int64), b["n"].astype(np.int64)
        return np.minimum(x, y) * lines.den >= np.maximum(x, y) * lines.num

    return near


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, line) of the wanted places of whole texts."""
    for batch in batches:
        nodes, told = [], []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            own = text.split("\n")
            nodes += [place["node"] for place in wanted]
            told += [own[place["at"]] for place in wanted]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(told, pa.string())], names=["node", "line"])


def _folded(bitmaps: list[bytes], lengths: np.ndarray, length: int) -> np.ndarray:
    """[line, word]: the bitmaps of at least ``length`` bytes, brought to that length; others are empty."""
    out = np.zeros((len(bitmaps), length // 8), dtype=np.uint64)
    for own in np.unique(lengths[lengths >= length]).tolist():
        at = np.flatnonzero(lengths == own)
        words = np.frombuffer(b"".join([bitmaps[k] for k in at.tolist()]), dtype=np.uint64)
        out[at] = np.bitwise_or.reduce(words.reshape(len(at), own // length, length // 8), axis=1)
    return out


class Bitmaps:
    """Lines by their bitmaps. Bits that differ come from different shingles that only one line has,
    so there are never more than such shingles."""

    def __init__(self, bitmaps: list[bytes], most: np.ndarray, lines: Lines):
        self.bitmaps, self.most, self.lines = bitmaps, most.astype(np.int64), lines
        self.lengths = np.array([len(x) for x in bitmaps], dtype=np.int64)
        self.folded: dict[int, np.ndarray] = {}

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether lines i and j can be similar."""
        keep, both = np.zeros(len(i), dtype=bool), np.minimum(self.lengths[i], self.lengths[j])
        for length in np.unique(both).tolist():
            if length not in self.folded:
                self.folded[length] = _folded(self.bitmaps, self.lengths, length)
            words, at = self.folded[length], np.flatnonzero(both == length)
            step = max(1, PART * 16 // length)
            for low in range(0, len(at), step):
                k = at[low : low + step]
                apart = np.bitwise_count(words[i[k]] ^ words[j[k]]).sum(axis=1, dtype=np.int64)
                keep[k] = apart * (self.lines.den + self.lines.num) <= (self.most[i[k]] + self.most[j[k]]) * (self.lines.den - self.lines.num)
        return keep


def _close(lines: Lines):
    """Pairs (a, b, most_a, most_b, bits_a, bits_b) whose bitmaps do not rule the link out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            most = np.concatenate([batch.column(k).to_numpy() for k in (2, 3)])
            held = Bitmaps(batch.column(4).to_pylist() + batch.column(5).to_pylist(), most, lines)
            yield batch.select([0, 1]).filter(pa.array(held.near(np.arange(n), n + np.arange(n)), pa.bool_()))

    return run


def _close_within(lines: Lines):
    """The rows of groups (see ``in_tiles``) that can be similar to one of another component there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches):
            label, own, low, high = (table.column(c).to_numpy() for c in ("label", "own", "low", "high"))
            held = Bitmaps(table.column("bits").to_pylist(), table.column("most").to_numpy(), lines)
            some = np.zeros(len(table), dtype=bool)
            for i, j in pairs_within(starts):
                apart = (label[i] != label[j]) & ((low[i] == high[i]) | (own[i] != own[j])) & ~(some[i] & some[j])
                i, j = i[apart], j[apart]
                near = held.near(i, j)
                some[i[near]] = some[j[near]] = True
            kept = table.select([*TILE_KEY, "node", "label"]).filter(pa.array(some, pa.bool_()))
            yield from kept.combine_chunks().to_batches()

    return run


def _near(a: np.ndarray, b: np.ndarray, lines: Lines) -> bool:
    if min(len(a), len(b)) * lines.den < lines.num * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return lines.den * common >= lines.num * (len(a) + len(b) - common)


def _sorted_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets of at most 4,096 lines as one ascending array of (line, upper 52 bits of the shingle's
    hash), and where each line's begin and the last ends."""
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes + 1) - sizes - 1
    n = sizes - width + 1
    first = np.cumsum(n) - n
    with np.errstate(over="ignore"):
        one = _rolled(_codes("\n".join(texts)), width)
    line = np.repeat(np.arange(len(texts)), n)
    place = np.arange(int(n.sum())) - np.repeat(first, n) + np.repeat(starts, n)
    keys = distinct((line.astype(np.uint64) << np.uint64(52)) | (one[place] >> np.uint64(12)))
    return keys, np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(52))


def _linked(lines: Lines):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2047):
                yield part(batch.slice(low, 2047))

    def part(batch: pa.RecordBatch) -> pa.RecordBatch:
        ends = [c for k in (0, 1) for c in batch.column(k).to_pylist()]
        held = dict(zip(ends, [t for k in (2, 3) for t in batch.column(k).to_pylist()], strict=True))
        number = {node: i for i, node in enumerate(held)}
        keys, bounds = _sorted_sets(list(held.values()), lines.width)
        half = len(ends) // 2
        a, b = np.array([number[x] for x in ends[:half]]), np.array([number[x] for x in ends[half:]])
        sizes = np.diff(bounds)
        # What two sets share is at most what they share of each of 128 bins of the hashes.
        line = (keys >> np.uint64(52)).astype(np.int64)
        bins = np.bincount(line * 128 + (keys & np.uint64(127)).astype(np.int64), minlength=128 * len(held)).reshape(len(held), 128)
        most = np.minimum(bins[a], bins[b]).sum(axis=1)
        keep = lines.den * most >= lines.num * (sizes[a] + sizes[b] - most)
        hashes = keys & np.uint64(2**52 - 1)
        for k in np.flatnonzero(keep).tolist():
            keep[k] = _near(hashes[bounds[a[k]] : bounds[a[k] + 1]], hashes[bounds[b[k]] : bounds[b[k] + 1]], lines)
        return batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _joined(lines: Lines, node: np.ndarray, label: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between the components of a group of lines: for each two that a true link joins,
    enough links that they are joined, directly or over others."""
    kinds, member = np.unique(label, return_inverse=True)
    out: list[tuple[int, int]] = []
    if len(kinds) < 2:
        return out
    if len(sets) <= SMALL_GROUP:
        for i in range(len(sets)):
            for j in range(i):
                if member[i] != member[j] and _near(sets[i], sets[j], lines):
                    out.append((int(node[i]), int(node[j])))
                    member[member == member[i]] = member[j]
        return out
    sizes = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    both = held[column] > 1  # shingles of one line alone are in no intersection
    row, column = row[both], np.unique(column[both], return_inverse=True)[1]
    # Lines of the largest component need no comparison among themselves.
    few = np.flatnonzero(member != np.bincount(member).argmax())
    common = np.zeros((len(few), len(sets)), dtype=np.float32)
    width = int(column.max()) + 1 if len(column) else 0
    for low in range(0, width, TILE_COLUMNS):
        part = (column >= low) & (column < low + TILE_COLUMNS)
        holds = np.zeros((len(sets), min(TILE_COLUMNS, width - low)), dtype=np.float32)
        holds[row[part], column[part] - low] = 1
        common += holds[few] @ holds.T
    counts = common.astype(np.int64)
    near = lines.den * counts >= lines.num * (sizes[few][:, None] + sizes[None, :] - counts)
    near &= member[few][:, None] != member[None, :]
    parent = list(range(len(kinds)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in zip(*np.nonzero(near), strict=True):
        x, y = root(member[few[i]]), root(member[j])
        if x != y:
            parent[x] = y
            out.append((int(node[few[i]]), int(node[j])))
    return out


def _joining(lines: Lines):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches):
            node, label = table.column("node").to_numpy(), table.column("label").to_numpy()
            # A line is in several groups; its set is made once.
            nodes, at, back = np.unique(node, return_index=True, return_inverse=True)
            sets, out = _sets(table.column("line").take(pa.array(at)).to_pylist(), lines.width), []
            for low, high in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                out += _joined(lines, node[low:high], label[low:high], [sets[k] for k in back[low:high]])
            a, b = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _keys(id_col: str, text: Column) -> list[Column]:
    """96 bits that name a document by id and text."""
    return [F.xxhash64(F.col(id_col).cast("string"), text).alias("__line_k1"), F.hash(text).alias("__line_k2")]


KEY = ["__line_k1", "__line_k2"]


def _flags(area: Staging, docs: DataFrame, lines: Lines, id_col: str, text_col: str) -> DataFrame:
    """Per document that loses a line: its key and a flag per line, true for those that go."""
    text = F.col(text_col).cast("string")
    read = docs.where(F.col(text_col).isNotNull()).select(*_keys(id_col, text), F.col(id_col).alias("id"), text.alias("text"))
    schema = read.drop("text").schema.add("names", ArrayType(LongType())).add("nodes", ArrayType(LongType())).add("sigs", BinaryType())
    schema = schema.add("bits", ArrayType(BinaryType())).add("most", ArrayType(IntegerType()))
    rows = area.write(read.mapInArrow(_named(lines), schema))
    mapped = rows.select(F.explode(F.arrays_zip(F.col("nodes").alias("node"), "bits", "most")).alias("z")).select("z.node", "z.bits", "z.most")
    new = rows.agg(F.sum(F.size("nodes"))).first()[0]
    entries = rows.select("nodes", "most", "sigs").mapInArrow(_indexed(lines, buckets_of((new or 0) * lines.bands)), "bucket int, held binary")
    index = shared(entries, ENTRY, _alike_in_size(lines))
    # A copy of the names alone, so what is large in the rows need not stay to the end.
    names = area.write(rows.select(*KEY, "id", "names"))
    placed = names.select(*KEY, F.struct(F.col("id").isNull().alias("none"), "id", *KEY).alias("doc"), F.posexplode("names").alias("at", "node"))
    placed = placed.where("node is not null")
    # Equal lines first: from here on a line is one row, however many documents have it.
    places = area.write(placed.groupBy("node").agg(F.min(F.struct("doc", "at")).alias("first"), F.count("*").alias("n")))

    staged = {}

    def texts(nodes: DataFrame) -> DataFrame:
        """(node, line) of some nodes, read from the first document that holds each."""
        held = places.join(nodes.distinct(), "node").select(*[F.col(f"first.doc.{k}").alias(f"of{k}") for k in KEY], F.struct("node", F.col("first.at").alias("at")).alias("place"))
        holders = area.write(held)
        wanted = holders.groupBy(*[f"of{k}" for k in KEY]).agg(F.collect_list("place").alias("wanted"))
        wanted = F.broadcast(wanted) if holders.count() <= BROADCAST_KEYS else wanted
        holding = docs.where(F.col(text_col).isNotNull()).select(*_keys(id_col, text), text.alias("text"))
        holding = holding.join(wanted, [F.col(k) == F.col(f"of{k}") for k in KEY]).select("text", "wanted")
        told = area.write(holding.mapInArrow(_told, "node long, line string").dropDuplicates(["node"]))
        area.drop(holders)
        return told

    def verifier(nodes: DataFrame):
        wanted = area.write(nodes)
        staged["bits"] = bits = area.write(semi_by_key(mapped, wanted, ["node"]).dropDuplicates(["node"]))
        area.drop(wanted, rows)

        def verify(pairs: DataFrame) -> DataFrame:
            a, b = (bits.select(F.col("node").alias(end), F.col("most").alias(f"most_{end}"), F.col("bits").alias(f"bits_{end}")) for end in "ab")
            sized = pairs.join(a, "a").join(b, "b").select("a", "b", "most_a", "most_b", "bits_a", "bits_b")
            close = area.write(sized.mapInArrow(_close(lines), "a long, b long"))
            told = texts(close.select(F.col("a").alias("node")).unionByName(close.select(F.col("b").alias("node"))))
            x, y = told.select(F.col("node").alias("a"), F.col("line").alias("x")), told.select(F.col("node").alias("b"), F.col("line").alias("y"))
            links = area.write(close.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_linked(lines), "a long, b long"))
            area.drop(close, told)
            return links

        return verify

    def across(rest: DataFrame) -> DataFrame:
        close = area.write(in_tiles(rest, staged["bits"]).mapInArrow(_close_within(lines), "sig long, low long, high long, node long, label long"))
        area.drop(staged["bits"])
        told = texts(close.select("node"))
        dealt = close.join(told, "node").repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY, "node")
        links = area.write(dealt.mapInArrow(_joining(lines), "a long, b long").distinct())
        area.drop(close, told)
        return links

    labels = resolve(area, index, verifier, across)
    # The first place of each component that has more than one, for each of its lines.
    # A line without link or copy stays, so it is left out here.
    named = places.join(labels, "node", "left").where("label is not null or n > 1").withColumn("label", F.coalesce("label", "node"))
    repeated = named.groupBy("label").agg(F.min("first").alias("keep"), F.sum("n").alias("all")).where(F.col("all") > 1)
    doomed = area.write(named.join(repeated, "label").select("node", "keep", "n"))
    area.drop(places, labels)
    # Lines that very many places hold are few, at most ``HEAVY``, and go to the places.
    total = doomed.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") > F.lit(total / HEAVY)
    known = doomed.where(often).select(F.col("node").alias("of"), "keep")
    marked = placed.join(F.broadcast(known), F.col("node") == F.col("of"), "left")
    common = marked.where(F.col("of").isNotNull()).drop("of")
    rare = marked.where(F.col("of").isNull()).drop("of", "keep").join(doomed.where(~often).select("node", "keep"), "node")
    going = common.unionByName(rare).where(F.struct("doc", "at") != F.col("keep")).select(*KEY, "at").distinct()
    losing = going.groupBy(*KEY).agg(F.collect_set("at").alias("gone"))
    return area.write(losing, keep=True)


def _without(lines: str, gone: str) -> Column:
    """The array less the places in ``gone`` (ascending), as the runs between them: linear."""
    before = lambda j: F.when(j == 0, F.lit(0)).otherwise(F.get(F.col(gone), j - 1) + 1)
    after = lambda j: F.coalesce(F.get(F.col(gone), j), F.size(lines))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), lambda j: F.slice(F.col(lines), before(j) + 1, after(j) - before(j))))


def dedup_lines(docs: DataFrame, lines: Lines = Lines(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:  # noqa: B008
    """The rows of ``docs`` with the text of the lines that stay, and ``n_lines`` and
    ``n_removed``, which replace columns of these names."""
    with staging(docs.sparkSession, "lines") as area:
        gone = _flags(area, docs, lines, id_col, text_col).withColumnRenamed("gone", "__line_gone")
        text = F.col(text_col).cast("string")
        k1, k2 = _keys(id_col, text)
        joined = docs.withColumn("__line_k1", k1).withColumn("__line_k2", k2).join(gone, KEY, "left")
        joined = joined.withColumn("__line_gone", F.sort_array("__line_gone")).withColumn("__line_all", F.split(text, "\n", -1))
        kept = F.when(F.col("__line_gone").isNull(), text).otherwise(F.array_join(_without("__line_all", "__line_gone"), "\n"))
        return joined.select(
            *[kept.alias(c) if c == text_col else F.col(c) for c in docs.columns if c not in ("n_lines", "n_removed")],
            F.coalesce(F.size("__line_all"), F.lit(0)).cast("bigint").alias("n_lines"), F.coalesce(F.size("__line_gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        )
