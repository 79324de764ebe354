"""Best-fit packing of tokenised documents by minimum bin slack.

Documents are tokenised whole, closed by an end id, and only those longer than a sequence are
cut into full pieces (the first takes the remainder). What packing needs is the number of
pieces per length: at most as many numbers as a sequence has tokens. For each sequence the
longest open piece is fixed and a subset-sum over the available lengths, kept as bits of one
integer, finds the fullest combination; it is removed as often as the counts allow. Every
step uses up a length, so the plan's size does not depend on the data.

Pieces of one length are interchangeable. They are numbered across the corpus from counts per
task, and the plan turns a piece's number into sequence and offset.

Null text counts as empty (its end id alone). Repeated rows are packed each on their own. An
empty table gives an empty result. Columns beside id and text are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from series_lake.llm.staging import staging

CAPACITY = 1024
END_ID = 2
#: Texts of these characters alone, without an angle bracket before a bar, are split alike by
#: both tokenizer libraries; the faster one takes them.
PLAIN = re.compile("[\t\n\r\\x20-\\x7e¡-¬®-ɏ]*")
LONG_RUN = re.compile(r"[^\x20\n]{2000}")


def encoder(vocabulary: str):
    """Function text -> ids: those of ``tokenizers`` for the named vocabulary file."""
    import public_tokenizers
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path(vocabulary) if "/" not in vocabulary else vocabulary)
    fast = None
    if vocabulary == "byte_bpe_50k.json":  # its ranks are given as well
        import tiktoken

        with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if fast is not None and "<|" not in text and PLAIN.fullmatch(text) and not LONG_RUN.search(text):
            return fast.encode_ordinary(text)
        return slow.encode(text, add_special_tokens=False).ids

    return encode


def pieces_of(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but for the first."""
    first = total % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, total, capacity))] if total > capacity else [(0, total)]


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, nth bigint"


def _cut(vocabulary: str, end_id: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = encoder(vocabulary), TaskContext.get().partitionId(), {}
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array(encode(text.as_py() or ""), dtype="<u4")
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, (at, n) in enumerate(pieces_of(len(ids), capacity)):
                    nth = seen.get(n, 0)
                    seen[n] = nth + 1
                    own = ids[at : at + n]
                    rows.append((doc, k, at, n, zlib.crc32(own.tobytes()), task, nth, *([own.astype(np.int32)] if with_ids else [])))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids"]
            columns = list(zip(*rows, strict=True)) if rows else [()] * (7 + with_ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names=names[: len(columns)])

    return run


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths and how many of each fill ``room`` best; bit i of a state: sum i can be reached."""
    mask, state, states = (1 << (room + 1)) - 1, 1, []
    lengths = sorted(n for n, c in counts.items() if c and n <= room)
    for n in lengths:
        states.append(state)
        left, step = min(counts[n], room // n), 1
        while left:  # 1, 2, 4, ... copies reach every number of copies
            take = min(step, left)
            state |= (state << (take * n)) & mask
            left, step = left - take, step * 2
    at, out = state.bit_length() - 1, {}
    for n, before in zip(reversed(lengths), reversed(states), strict=True):
        for copies in range(min(counts[n], at // n), -1, -1):
            if before >> (at - copies * n) & 1:
                break
        if copies:
            out[n] = copies
            at -= copies * n
    return out


def plan_bins(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Rows (length, first number, bins, copies per bin, first bin, offset of the first copy),
    and the number of bins."""
    left, used, out, bins = dict(counts), dict.fromkeys(counts, 0), [], 0
    while any(left.values()):
        longest = max(n for n, c in left.items() if c)
        left[longest] -= 1
        pattern = fullest(left, capacity - longest)
        left[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times, offset = min(left[n] // c for n, c in pattern.items()), 0
        for n in sorted(pattern, reverse=True):
            c = pattern[n]
            out.append((n, used[n], times, c, bins, offset))
            offset += c * n
            used[n] += times * c
            left[n] -= times * c
        bins += times
    return out, bins


def _place(plan: list[tuple[int, int, int, int, int, int]]):
    """Sequence and offset of pieces from their length and number; the plan is small."""
    table = np.array(sorted(plan), dtype=np.int64).reshape(-1, 6)
    lengths, at, many = np.unique(table[:, 0], return_index=True, return_counts=True)
    first_of = {int(n): (int(a), int(a + b)) for n, a, b in zip(lengths, at, many, strict=True)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                low, high = first_of[int(n)]
                part = table[low:high]
                row = part[np.searchsorted(part[:, 1], number[own], side="right") - 1]
                inside = number[own] - row[:, 1]
                sequence[own] = row[:, 4] + inside // row[:, 3]
                offset[own] = row[:, 5] + inside % row[:, 3] * n
            kept = [c for c in batch.schema.names if c not in ("task", "nth", "number")]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in kept], pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = "byte_bpe_50k.json", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset; with
    ``with_ids`` the piece's ids too. ``vocabulary``: a file of the public tokenizers, or a path
    that every executor has."""
    spark = docs.sparkSession
    schema = PIECES + (", ids array<int>" if with_ids else "")
    with staging(spark, "pack") as area:
        read = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        pieces = area.write(read.mapInArrow(_cut(vocabulary, end_id, capacity, with_ids), schema), keep=True)
        per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
        before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        starts = area.write(per_task.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"), keep=True)
        counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
        plan, _ = plan_bins(counts, capacity)
        numbered = pieces.join(starts.hint("merge"), ["task", "length"])  # grows with the tasks: not for every task
        numbered = numbered.withColumn("number", F.col("first") + F.col("nth")).drop("first")
        order = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
        placed = f"{schema.replace(', task int, nth bigint', '')}, sequence_id bigint, offset bigint"
        return numbered.select(*order, "number").mapInArrow(_place(plan), placed)
