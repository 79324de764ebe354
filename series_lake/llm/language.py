"""Language identification by mixture inference.

A document is a mixture of languages. For each learned language the frequencies of byte
trigrams (lower-cased, everything but letters as gaps, hashed into a fixed number of buckets)
are counted over all labelled documents. Expectation-maximisation then estimates a document's
language proportions from the likelihoods of its trigrams. Sets of the best 1, 2, ...
languages are compared by penalised likelihood (one penalty per further language, growing with
the logarithm of the evidence), and the set's largest proportion names the document.

Labels are read only where the remainder of crc32(id as text) by ``folds`` is not ``held_out``;
ids and labels are no inputs of a prediction. A document without id teaches nothing and is not
held out. Null texts and texts without a letter, and all texts when nothing was learned, give
``und`` with score 0. Rows are predicted independently; repeated rows repeat. More than
``max_languages`` labels is an error. Columns beside those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
BUCKETS = 1 << 15
STEPS = 12
PENALTY = 2.0
MAX_LANGUAGES = 500
PART = 1 << 20


def _letters() -> np.ndarray:
    """Byte to byte: lower case for A-Z, itself for a-z and bytes above 127, else a space."""
    table = np.full(256, 0x20, dtype=np.uint8)
    table[0x61:0x7B] = np.arange(0x61, 0x7B)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    table[0x80:] = np.arange(0x80, 0x100)
    return table


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of a text between two gaps, those around a gap's middle left out."""
    found = []
    data, table = b" " + text.encode("utf-8", "replace") + b" ", _letters()  # so that one letter is a trigram
    for at in range(0, len(data), PART):
        b = table[np.frombuffer(data[at : at + PART + 2], dtype=np.uint8)]
        if len(b) < 3:
            break
        # Latin capitals with accents are C3 80 .. C3 9E in UTF-8, their lower case 32 higher.
        capital = np.flatnonzero((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E)) + 1
        b[capital] += 32
        x = b.astype(np.uint32)
        key = (x[:-2] << 16 | x[1:-1] << 8 | x[2:])[b[1:-1] != 0x20]
        found.append((key * np.uint32(2654435761)) >> np.uint32(32 - 15))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            own += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
    for lang, own in counts.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])], names=["lang", "bucket", "n"])
        if not len(at):  # a label whose texts have no trigram is a label all the same
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0], pa.int32()), pa.array([0], pa.int64())], names=["lang", "bucket", "n"])


class Model:
    """Trigram likelihoods [bucket, language], smoothed."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        if not languages:
            return
        smooth = counts + 0.5
        likelihood = smooth / smooth.sum(axis=0, keepdims=True)
        # Scaled per bucket, which changes all sets of languages alike.
        self.likelihood = (likelihood / likelihood.max(axis=1, keepdims=True)).astype(np.float32)

    def proportions(self, text: str) -> tuple[list[int], np.ndarray]:
        """The chosen languages (numbers) and their shares, the largest first."""
        found = trigrams(text)
        if not len(found):
            return [0], np.ones(1)
        at, n = np.unique(found, return_counts=True)
        p, n = self.likelihood[at], n.astype(np.float32)
        total = float(n.sum())
        everything = self._em(p, n, total)
        order = np.argsort(-everything, kind="stable")
        best, chosen = None, ([int(order[0])], np.ones(1))
        for size in range(1, len(order) + 1):
            members = order[:size]
            own = p[:, members]
            shares = np.ones(1) if size == 1 else self._em(own, n, total)
            # Every byte is in three trigrams: a third of the sum is the evidence.
            fit = float(n @ np.log(own @ shares.astype(np.float32))) / 3
            cost = -2 * fit + PENALTY * (size - 1) * np.log(total + 1)
            if best is not None and cost >= best:
                break
            place = np.argsort(-shares, kind="stable")
            best, chosen = cost, ([int(members[i]) for i in place], shares[place])
        return chosen

    @staticmethod
    def _em(p: np.ndarray, n: np.ndarray, total: float) -> np.ndarray:
        shares = np.full(p.shape[1], 1 / p.shape[1], dtype=np.float32)
        for _ in range(STEPS):
            before, shares = shares, shares * ((n / (p @ shares)) @ p) / total
            if np.abs(shares - before).max() < 1e-3:
                break
        return shares


def held_out(id_col: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, fold: int = 1, max_languages: int = MAX_LANGUAGES) -> Model:
    """Counts over all labelled documents that are not held out."""
    teaching = F.col(id_col).isNotNull() & ~held_out(F.col(id_col), folds, fold) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    labelled = docs.where(teaching).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    if len(labelled.select("lang").distinct().limit(max_languages + 1).collect()) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    counts = labelled.mapInArrow(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counts.toArrow()  # at most languages x buckets rows
    languages = sorted(set(rows.column("lang").to_pylist()))
    number = {x: i for i, x in enumerate(languages)}
    table = np.zeros((BUCKETS, len(languages)))
    if languages:
        column = np.array([number[x] for x in rows.column("lang").to_pylist()])
        table[rows.column("bucket").to_numpy(), column] = rows.column("n").to_numpy()
    return Model(languages, table)


def _predicted(model: Model, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for text, letter in zip(batch.column(text_col), batch.column("__lang_letter").to_pylist(), strict=True):
                if not letter or not model.languages:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                chosen, shares = model.proportions(text.as_py())
                names.append(model.languages[chosen[0]])
                scores.append(min(1.0, max(0.0, float(shares[0]))))
            keep = [i for i, c in enumerate(batch.schema.names) if not c.startswith("__lang_")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*[batch.schema.names[i] for i in keep], "__lang_pred", "__lang_score"],
            )

    return run


def identify(docs: DataFrame, model: Model, carry: list[str], text_col: str = "text") -> DataFrame:
    """The ``carry`` columns with ``__lang_pred`` and ``__lang_score``, a row per row of ``docs``."""
    text = F.col(text_col).cast("string")
    letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("__lang_letter")
    read = docs.select(*carry, letter) if text_col in carry else docs.select(*carry, text.alias("__lang_text"), letter)
    schema = read.select(*carry).schema.add("__lang_pred", "string").add("__lang_score", "double")
    return read.mapInArrow(_predicted(model, text_col if text_col in carry else "__lang_text"), schema)
