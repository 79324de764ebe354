"""Periodic runs of words: stretches that repeat a block of words at least four times or so.

A run is a stretch of consecutive words whose smallest period is q (words q apart are equal), of
at least ``max(least, times * q)`` words, that no neighbouring word extends keeping period q.

They are found by an online dynamic programme over diagonals. A diagonal is a lag d; its match
length at word i is how many words in a row, up to i, equal the word d before them. Word by word,
the earlier occurrences of the word add one to the lengths of their lags; a lag whose word differs
ends there, and if its length suffices its run is emitted at once.

The programme is sparse: of a word's earlier occurrences only those that can lie on a run open a
diagonal. A run of period d holds at least (times - 1) * d matches, so for lags a <= d < b it holds
two equal contexts of K words, d apart, where 2 d <= K <= (times - 1) * d. If an equal context stood
nearer, the context and with it the run would have a smaller period. Hence at the first word where
its context matches, the lag of a run is the distance to the *latest* earlier occurrence of that
context, and the match length there is K. With lags in classes that grow by half, a word opens at
most one diagonal per class: the work is linear in the words for each of log n classes, also in
texts of one word repeated, and only words whose context repeats go on to the next class.
Lags that a smaller period divides never open, since its contexts are nearer.

Words are ``[^\\x20\\x09-\\x0D]+`` and compared exactly. A word is dropped from the collapsed text if
a run holds it after that run's first q words; the others are joined by one space. Null and empty
texts have no words, no runs and an empty collapsed text. Repeated rows are rows of their own.
Whole texts are read, however long. An empty table gives an empty result. Other columns pass as
they are, but for those named like the results, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that are named together: many short texts, or one long one.
PART = 1 << 17
LEAST = 6
TIMES = 4


def lag_classes(longest: int, times: int = TIMES) -> Iterator[tuple[int, int, int]]:
    """(a, b, K) of the lags a <= d < b, up to the longest: contexts of K words tell their runs."""
    a = 1
    while a <= longest:
        size = (times - 1) * a
        b = size // 2 + 1
        yield a, b, size
        a = b


def _repeated(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts with ``keys`` at the ascending places ``at``: those that occur more than once, as
    places, names, and distances to the latest earlier occurrence (0: none)."""
    order = np.argsort(keys, kind="stable")
    sorted_ = keys[order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = sorted_[1:] != sorted_[:-1]
    name = np.cumsum(first)
    alone = first & np.append(first[1:], True)
    places = at[order]
    lag = np.where(first, 0, places - np.append(places[:1], places[:-1]))
    keep = ~alone
    back = np.argsort(places[keep], kind="stable")
    return places[keep][back], name[keep][back], lag[keep][back]


def openings(words: np.ndarray, text: np.ndarray, longest: int, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, lag, match length) where diagonals open, by word. ``words`` are numbers of the words of
    several texts in a row, ``text`` the number of the text of each."""
    n = len(words)
    found = []
    # Words of different texts are different, so contexts never span or match across texts.
    at, name, lag = _repeated(text.astype(np.int64) * (int(words.max(initial=0)) + 1) + words, np.arange(n))
    size = 1
    named = np.zeros(n + 1, dtype=np.int64)  # 0: occurs once, so on no run
    for a, b, wanted in lag_classes(longest // times, times):
        while size < wanted and len(at):
            step = min(size, wanted - size)
            named[:] = 0
            named[at] = name
            other = named[np.minimum(at + step, n)]
            both = other > 0
            at, name, lag = _repeated(name[both] * (n + 1) + other[both], at[both])
            size += step
        if not len(at):
            break
        opens = (lag >= a) & (lag < b)
        places, lags = at[opens], lag[opens]
        # A diagonal opens where it was not open one word before.
        new = np.ones(len(places), dtype=bool)
        new[1:] = (places[1:] != places[:-1] + 1) | (lags[1:] != lags[:-1])
        found.append((places[new] + size - 1, lags[new], np.full(int(new.sum()), size)))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    word, lags, sizes = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((lags, word))
    return word[order], lags[order], sizes[order]


def follow(words: list[int], opened: list[tuple[int, int, int]], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one text, by start, then period: the programme
    itself, word by word over the open diagonals."""
    length: dict[int, int] = {}
    runs = []
    n, k, i = len(words), 0, 0

    def end(lag: int) -> None:
        matched = length.pop(lag)
        if matched + lag >= max(least, times * lag):
            runs.append((i - matched - lag, matched + lag, lag))

    while i < n and (length or k < len(opened)):
        if not length:
            i = opened[k][0]  # no diagonal to follow until the next one opens
        for lag in list(length):
            if words[i] == words[i - lag]:
                length[lag] += 1
            else:
                end(lag)
        while k < len(opened) and opened[k][0] == i:
            length.setdefault(opened[k][1], opened[k][2])
            k += 1
        i += 1
    for lag in list(length):
        end(lag)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of(texts: list[np.ndarray], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several texts, given as numbers of their words."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    words = np.concatenate([*texts, np.zeros(0, np.int64)])
    text = np.repeat(np.arange(len(texts)), sizes)
    word, lag, size = openings(words, text, int(sizes.max(initial=0)), times)
    bounds = np.searchsorted(word, np.cumsum([0, *sizes]))
    starts = np.cumsum(sizes) - sizes
    out = []
    for k, own in enumerate(texts):
        low, high = bounds[k], bounds[k + 1]
        opened = list(zip((word[low:high] - starts[k]).tolist(), lag[low:high].tolist(), size[low:high].tolist(), strict=True))
        out.append(follow(own.tolist(), opened, least, times) if opened else [])
    return out


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of ``n`` words lies in a run after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) > 0


def _found(text_col: str, least: int, times: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def described(texts: list[bytes]) -> Iterator[tuple[list[dict], str, int]]:
        split = [t.split() for t in texts]  # bytes split at just the six white space characters
        number: dict[bytes, int] = {}
        coded = [np.fromiter((number.setdefault(w, len(number)) for w in own), dtype=np.int64, count=len(own)) for own in split]
        for own, runs in zip(split, runs_of(coded, least, times), strict=True):
            n = len(own)
            if runs:
                gone = dropped(n, runs).tolist()
                own = [w for w, g in zip(own, gone, strict=True) if not g]
            yield [{"start": s, "length": z, "period": q} for s, z, q in runs], b" ".join(own).decode(), n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, part, size = [], [], 0
            for cell in batch.column(text_col):
                part.append((cell.as_py() or "").encode())
                size += len(part[-1])
                if size >= 8 * PART:
                    rows += described(part)
                    part, size = [], 0
            rows += described(part)
            runs, left, n = zip(*rows, strict=True) if rows else ((), (), ())
            kept = [c for c in batch.schema.names if c != text_col]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in kept], pa.array(n, pa.int64()), pa.array(runs, kind), pa.array(left, pa.string())],
                names=[*kept, "n_words", "runs", "collapsed"],
            )

    return run


def periodic_runs(docs: DataFrame, carry: list[str], text: Column | str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """The ``carry`` columns, ``n_words``, ``runs`` (array of struct<start, length, period> by start,
    then period) and ``collapsed``, a row per row of ``docs``.

    ``times`` is at least 4: fewer repetitions leave no context of two periods.
    """
    if times < 4:
        raise ValueError("times must be 4 or more")
    text = F.col(text) if isinstance(text, str) else text
    carry = [c for c in carry if c not in ("n_words", "runs", "collapsed")]
    read = docs.select(*carry, text.cast("string").alias("__run_text"))
    kind = F.lit(None).cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    schema = read.select(*carry, F.lit(0).cast("bigint").alias("n_words"), kind.alias("runs"), F.lit("").alias("collapsed")).schema
    return read.mapInArrow(_found("__run_text", least, times), schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, exactly; ties to the smallest start, then
    period. Null without a run."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, none, lambda best, r: F.when(better(best, r), r).otherwise(best))


def run_text(runs: Column) -> Column:
    """``start,length,period`` and a line feed for every run, in the order of the array."""
    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")
