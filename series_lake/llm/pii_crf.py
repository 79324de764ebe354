"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give the base spans. The field labels every token that holds a digit or an at
sign (any other token can be no entity and cuts the chain): neighbours in the text are linked,
and so are distant tokens that repeat or resemble each other, each to its next such token. The
links share potentials, and loopy message passing makes labels consistent over the document.
Runs of tokens whose marginal is high become added spans where no base span lies.

Trained here: token weights by maximum likelihood, link potentials from label agreement, on
the base labels of at most ``sample`` documents, chosen by a hash of their ids. Prediction
covers every whole text. Without training tokens nothing is added.

Null text counts as empty. Repeated rows repeat their result; an empty table gives an empty
result. Other columns are not read. Spans are in code points, end exclusive.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0: no entity; k + 1: KINDS[k]
SAMPLE = 4000
CUT = 0.9
ROUNDS = 10
MOST = 3.0

# The base patterns. Mail addresses are found from their at signs, which gives
# the leftmost matches without trying every start of a long run.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SOME = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = "\"'`,;:!?<>[]{}|#$%&*=~"


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        n = int(ch) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    out += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def tokens_of(text: str) -> tuple[list[tuple[int, int, str]], list[bool]]:
    """Tokens with a digit or an at sign (start, end, token; outer punctuation off), and whether
    each follows the one before it directly."""
    out, adjacent, position = [], [], 0
    last_end = -1
    while m := SOME.search(text, position):
        start = m.start()
        while start > position and not text[start - 1].isspace():
            start -= 1
        end = TOKEN.match(text, m.start()).end()
        token = text[start:end]
        left = len(token) - len(token.lstrip(EDGES))
        bare = token.strip(EDGES).rstrip(".")
        if bare and SOME.search(bare):
            adjacent.append(bool(out) and not text[last_end:start].strip())
            out.append((start + left, start + left + len(bare), bare))
            last_end = end
        position = end
    return out, adjacent


def features(token: str) -> list[float]:
    digits = "".join(c for c in token if "0" <= c <= "9")
    n, parts = len(digits), token.split(".")
    letters = sum(c.isalpha() for c in token)
    four = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    return [
        1.0, "@" in token, bool(re.search(r"@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+$", token)), token.startswith("+"), "(" in token and ")" in token,
        n == 0, 1 <= n <= 3, 4 <= n <= 7, 8 <= n <= 15, 16 <= n <= 19, n > 19, 16 <= n <= 19 and luhn(digits), n == len(token) and n > 0,
        "-" in token, letters == 0, letters > n, four, four and all(len(p) <= 3 and int(p) <= 255 for p in parts), len(parts) > 1, len(token) > 24,
        bool(re.fullmatch(r"[0-9]{3}-[0-9]{4}", token)), bool(re.fullmatch(r"[0-9a-f]{16,}", token)) and letters > 0,
    ]


N_FEATURES = 22


def _skip_key(token: str) -> str:
    """Equal for tokens that repeat or resemble each other: same digits, or same mail domain, or
    same outline."""
    if "@" in token:
        return "@" + token.rpartition("@")[2].lower()
    digits = "".join(c for c in token if "0" <= c <= "9")
    return digits if len(digits) >= 7 else re.sub(r"[0-9]", "9", token)


def links(tokens: list[tuple[int, int, str]], adjacent: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens and their type (0: chain, 1: skip); each token skips to its next like."""
    pairs, kinds, last = [], [], {}
    for i, (_, _, token) in enumerate(tokens):
        if adjacent[i]:
            pairs.append((i - 1, i))
            kinds.append(0)
        key = _skip_key(token)
        if key in last and not (adjacent[i] and last[key] == i - 1):
            pairs.append((last[key], i))
            kinds.append(1)
        last[key] = i
    return np.array(pairs, dtype=np.int64).reshape(-1, 2), np.array(kinds, dtype=np.int64)


def labels_of(tokens: list[tuple[int, int, str]], spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Label of each token: the first base span that it overlaps."""
    out = np.zeros(len(tokens), dtype=np.int64)
    starts = np.array([t[0] for t in tokens])
    ends = np.array([t[1] for t in tokens])
    for kind, start, end in reversed(spans):
        low, high = np.searchsorted(ends, start, side="right"), np.searchsorted(starts, end, side="left")
        out[low:high] = kind + 1
    return out


class Field:
    """Weights [feature, label] and potentials [link type, label, label]."""

    def __init__(self, weights: np.ndarray, potentials: np.ndarray):
        self.weights, self.potentials = weights, potentials

    def marginals(self, tokens: list[tuple[int, int, str]], adjacent: list[bool]) -> np.ndarray:
        unary = np.array([features(t) for _, _, t in tokens], dtype=np.float64) @ self.weights
        pairs, kinds = links(tokens, adjacent)
        m = len(pairs)
        incoming = np.zeros_like(unary)
        if m:
            source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
            back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
            table = np.concatenate([self.potentials[kinds], self.potentials[kinds].transpose(0, 2, 1)])
            messages = np.zeros((2 * m, LABELS))
            # a message passes a link per round: rounds for any chain, or until none changes
            for _ in range(ROUNDS + 2 * m):
                sent = (unary + incoming)[source] - messages[back]
                scores = table + sent[:, :, None]
                top = scores.max(axis=1)
                new = top + np.log(np.exp(scores - top[:, None, :]).sum(axis=1))
                new -= new.max(axis=1, keepdims=True)
                change = np.abs(new - messages).max()
                messages = 0.5 * messages + 0.5 * new
                incoming = np.zeros_like(unary)
                np.add.at(incoming, target, messages)
                if change < 1e-3:
                    break
        belief = unary + incoming
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)


def added_spans(text: str, base: list[tuple[int, int, int]], field: Field) -> list[tuple[int, int, int]]:
    tokens, adjacent = tokens_of(text)
    if not tokens:
        return []
    chance = field.marginals(tokens, adjacent)
    label = chance.argmax(axis=1)
    label[chance.max(axis=1) < CUT] = 0
    runs: list[list[int]] = []  # kind, start, end, digits
    for i, (start, end, token) in enumerate(tokens):
        if not label[i]:
            continue
        kind, n = int(label[i]) - 1, sum("0" <= c <= "9" for c in token)
        # Phones and cards may be written in several tokens; a further one must still fit.
        if runs and adjacent[i] and label[i - 1] == label[i] and kind >= 2 and runs[-1][3] + n <= (19, 15)[kind - 2] and text[runs[-1][2] : start].strip() == "":
            runs[-1][2], runs[-1][3] = end, runs[-1][3] + n
        else:
            runs.append([kind, start, end, n])
    taken = sorted((s, e) for _, s, e in base)
    starts, ends = np.array([s for s, _ in taken]), np.maximum.accumulate([e for _, e in taken]) if taken else np.array([])
    out = []
    for kind, start, end, n in runs:
        before = int(np.searchsorted(starts, end, side="left")) if taken else 0
        whole = {0: "@" in text[start:end], 1: n >= 4, 2: 16 <= n <= 19, 3: 8 <= n <= 15}[kind]
        if whole and not (before and ends[before - 1] > start):
            out.append((kind, start, end))
    return out


def _packed(token: str) -> int:
    """The features, all of which are yes or no, as the bits of a number."""
    return sum(1 << i for i, v in enumerate(features(token)) if v)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(what, a, b, n): how often features a have label b (what -1), and how often a link of kind
    ``what`` joins labels a and b, over a task."""
    seen: Counter[tuple[int, int, int]] = Counter()
    for batch in batches:
        for cell in batch.column(0):
            text = cell.as_py()
            tokens, adjacent = tokens_of(text)
            if not tokens:
                continue
            y = labels_of(tokens, base_spans(text))
            seen.update(zip([-1] * len(tokens), [_packed(t) for _, _, t in tokens], y.tolist(), strict=True))
            pairs, kinds = links(tokens, adjacent)
            seen.update(zip(kinds.tolist(), y[pairs[:, 0]].tolist(), y[pairs[:, 1]].tolist(), strict=True))
    what, first, second = zip(*seen, strict=True) if seen else ((), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (what, first, second, list(seen.values()))], names=["what", "a", "b", "n"])


def fit(x: np.ndarray, y: np.ndarray, times: np.ndarray, steps: int = 300) -> np.ndarray:
    """Softmax regression by accelerated gradient steps, lightly damped; row i counts ``times[i]``."""
    weights = np.zeros((x.shape[1], LABELS))
    if not len(x):
        return weights
    goal, momentum, share = np.eye(LABELS)[y], np.zeros_like(weights), (times / times.sum())[:, None]
    for _ in range(steps):
        z = x @ weights
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        momentum = 0.9 * momentum - 0.3 * (x.T @ (share * (p - goal)) + 1e-4 * weights)
        weights += momentum
    return weights


def _agreement(a: np.ndarray, b: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Log odds of label pairs over their chance, smoothed, symmetric, bounded."""
    table = np.full((LABELS, LABELS), 0.5)
    np.add.at(table, (a, b), times)
    table += table.T
    joint = table / table.sum()
    return np.clip(np.log(joint / (joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True))), -MOST, MOST)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Field:
    """From at most ``sample`` documents. Tokens with equal features and label are counted on Spark, so
    the driver gets a row per kind of token, however long the documents are."""
    key = F.xxhash64(F.col(id_col).cast("string"))
    share = min(1.0, 2 * sample / max(1, docs.count()))
    chosen = docs.where(F.col(text_col).isNotNull() & (F.pmod(key, F.lit(1 << 20)) < int(share * (1 << 20)) + 1))
    texts = chosen.select(F.col(text_col).cast("string").alias("text"), key.alias("key")).orderBy("key", F.xxhash64("text")).limit(sample).select("text")
    counted = texts.mapInArrow(_examples, "what long, a long, b long, n long").groupBy("what", "a", "b").agg(F.sum("n").alias("n")).orderBy("what", "a", "b")
    rows = np.array([tuple(r) for r in counted.collect()], dtype=np.int64).reshape(-1, 4)
    tokens = rows[rows[:, 0] == -1]
    x = ((tokens[:, 1:2] >> np.arange(N_FEATURES)) & 1).astype(np.float64)
    none = np.zeros((LABELS, LABELS))
    potentials = [_agreement(own[:, 1], own[:, 2], own[:, 3].astype(np.float64)) if len(own := rows[rows[:, 0] == k]) else none for k in (0, 1)]
    return Field(fit(x, tokens[:, 2], tokens[:, 3].astype(np.float64)), np.stack(potentials))


def _found(field: Field):
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cell in batch.column(1):
                text = cell.as_py()
                if not text or not SOME.search(text):
                    rows.append([])
                    continue
                base = base_spans(text)
                spans = [(*s, True) for s in base] + [(*s, False) for s in added_spans(text, base, field)]
                rows.append([{"kind": k, "start": s, "end": e, "base": known} for k, s, e, known in sorted(spans)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    return run


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """doc_id and ``spans`` (array of struct<kind, start, end, base> by kind, then start; ``kind``
    indexes KINDS), a row per row of ``docs``."""
    field = train(docs, id_col, text_col, sample)
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = read.select("doc_id", F.lit(None).cast("array<struct<kind:int,start:bigint,end:bigint,base:boolean>>").alias("spans")).schema
    return read.mapInArrow(_found(field), schema)


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
