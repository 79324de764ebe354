"""Benchmark decontamination: passages of test items in training text.

Test questions and answers are normalised to words, cut into windows of ``width`` consecutive words
and put into one Aho-Corasick automaton whose symbols are words. Each text is normalised the same
way and scanned once; a word inside any occurrence of a window is hit. Hits are mapped back to
character offsets of the original text.

Normalised: A-Z lower-cased, then words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, that is runs of
ASCII letters, digits and any characters beyond ASCII. An item of fewer words than ``width``, but
not none, is one window; one without words has none.

The automaton holds at most ``MOST_WORDS`` words of items (counted first), which every task gets. A
larger benchmark is cut into pieces that overlap by ``width`` - 1 words and dealt over several
automata, one scan each, so nothing is left out.

Null and empty texts have no words and no hits. Items are told apart by their id as text; a null id
is one more item, written as an empty text. Repeated rows of ``docs`` are rows of their own. Empty
tables give no hits or an empty result. Other columns pass as they are, but for those named like the
results, which are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from series_lake.llm.staging import staging

WIDTH = 10
#: Words of items in one automaton; each takes about ``WIDTH`` nodes of some 100 bytes.
MOST_WORDS = 200_000
PIECE = 10_000
RESULTS = ["n_words", "n_hit", "items", "spans"]

#: Bytes after normalising: lower case, and a space for what is in no word.
NORMAL = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def windows(words: list[bytes], width: int) -> Iterator[list[bytes]]:
    """The windows of an item."""
    if len(words) < width:
        if words:
            yield words
        return
    for i in range(len(words) - width + 1):
        yield words[i : i + width]


class Matcher:
    """The automaton of some pieces (item, words)."""

    def __init__(self, pieces: list[tuple[str, list[bytes]]], width: int):
        self.number: dict[bytes, int] = {}
        items: dict[tuple[int, ...], set[str]] = {}
        for item, words in pieces:
            for window in windows(words, width):
                key = tuple(self.number.setdefault(w, len(self.number) + 1) for w in window)
                items.setdefault(key, set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, own in items.items():
            self.automaton.add_word(key, (len(key), sorted(own)))
        if items:
            self.automaton.make_automaton()
        self.some = bool(items)

    def __call__(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Stretches of hit words [first, end), in order and apart, and the items that occur."""
        stretches: list[tuple[int, int]] = []
        items: set[str] = set()
        if not self.some or not words:
            return stretches, items
        number = self.number
        for at, (size, own) in self.automaton.iter(tuple([number.get(w, 0) for w in words])):
            stretches.append((at + 1 - size, at + 1))
            items.update(own)
        return joined(stretches), items


def joined(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching stretches as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(stretches):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def offsets(text: str, stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Characters [start, end) of the original text under stretches of words."""
    if not stretches:
        return []
    places = np.array([m.span() for m in ORIGINAL_WORD.finditer(text)])
    return [(int(places[low, 0]), int(places[high - 1, 1])) for low, high in stretches]


def _pieces(width: int):
    """(item, words, n) of the items in overlapping pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = normal_words(text.as_py())
                last = max(1, len(words) - width + 1) if words else 0
                for low in range(0, last, PIECE):
                    own = words[low : min(low + PIECE, last) + width - 1]
                    rows.append((item or "", b" ".join(own).decode(), len(own)))
            item, words, n = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["item", "words", "n"])

    return run


def _scanned(pieces: list[tuple[str, str]], width: int, first: bool):
    """Adds ``__hit`` (stretches of words), ``items`` and ``n_words``, to those of earlier scans."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher([(item, words.encode().split()) for item, words in pieces], width)
        for batch in batches:
            counts, hits, found, spans = [], [], [], []
            known = range(batch.num_rows) if first else zip(batch.column("__hit").to_pylist(), batch.column("items").to_pylist(), strict=True)
            for cell, before in zip(batch.column("__leak_text"), known, strict=True):
                text = cell.as_py() or ""
                words = normal_words(text)
                stretches, items = match(words)
                if not first:
                    stretches = joined(stretches + [(s["start"], s["end"]) for s in before[0]])
                    items |= set(before[1])
                counts.append(len(words))
                hits.append([{"start": a, "end": b} for a, b in stretches])
                found.append(sorted(items))
                spans.append([{"start": a, "end": b} for a, b in offsets(text, stretches)])
            kept = [c for c in batch.schema.names if c not in (*RESULTS, "__hit")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in kept], pa.array(counts, pa.int64()), pa.array([sum(s["end"] - s["start"] for s in h) for h in hits], pa.int64()),
                 pa.array(found, pa.list_(pa.string())), pa.array(spans, span), pa.array(hits, span)],
                names=[*kept, *RESULTS, "__hit"],
            )

    return run


def find_passages(docs: DataFrame, benchmark: DataFrame, carry: list[str], text: Column | str = "text", id_col: str = "item_id", item_col: str = "text", width: int = WIDTH, most_words: int = MOST_WORDS) -> DataFrame:
    """The ``carry`` columns with ``n_words``, ``n_hit`` (words inside an occurrence of a window),
    ``items`` (ids, as text, of the items with occurring windows) and ``spans`` (characters
    [start, end) of the hit stretches in the original text), a row per row of ``docs``."""
    text = F.col(text) if isinstance(text, str) else text
    carry = [c for c in carry if c not in RESULTS]
    with staging(docs.sparkSession, "leaks") as area:
        items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(item_col).cast("string").alias("text"))
        pieces = area.write(items.mapInArrow(_pieces(width), "item string, words string, n long"))
        scans = max(1, math.ceil((pieces.agg(F.sum("n")).first()[0] or 0) / most_words))
        scanned = docs.select(*carry, text.cast("string").alias("__leak_text"))
        schema = StructType(list(scanned.schema.fields))
        for name, kind in zip([*RESULTS, "__hit"], ["bigint", "bigint", "array<string>", *["array<struct<start:bigint,end:bigint>>"] * 2], strict=True):
            schema = schema.add(name, docs.sparkSession.range(0).select(F.lit(None).cast(kind)).schema[0].dataType)
        for k in range(scans):
            own = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(scans)) == k).select("item", "words").collect()  # about ``most_words`` words
            scanned = scanned.mapInArrow(_scanned([tuple(r) for r in own], width, k == 0), schema)
            if scans > 1:  # one automaton at a time in memory
                scanned = area.write(scanned, keep=k == scans - 1)
        return scanned.select(*carry, *RESULTS)


def without_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the hit stretches cut out of their texts; the text between them is joined by a
    space, and a null text stays null."""
    found = find_passages(docs, benchmark, [c for c in docs.columns if c not in RESULTS], F.col(text_col), **options)
    before = lambda j: F.when(j == 0, F.lit(0)).otherwise(F.get("spans", j - 1)["end"])
    after = lambda j: F.coalesce(F.get("spans", j)["start"], F.length(text_col).cast("bigint"))
    piece = lambda j: F.substr(F.col(text_col), (before(j) + 1).cast("int"), (after(j) - before(j)).cast("int"))
    left = F.array_join(F.transform(F.sequence(F.lit(0), F.size("spans")), piece), " ")
    cut = F.when(F.size("spans") == 0, F.col(text_col)).otherwise(left)
    return found.select(*[cut.alias(c) if c == text_col else F.col(c) for c in docs.columns if c not in RESULTS])
