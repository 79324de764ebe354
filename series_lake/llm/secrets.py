"""Secret scan: fixed patterns, and a battery of randomness tests on every other long token.

Everything is a DataFrame expression. For each token of 20 or more characters the encoding is
inferred from its characters (hex, base 32, letters and digits, base 64). Three tests ask
whether it could be uniform noise of that encoding: a chi-squared test of the symbol counts, a
Wald-Wolfowitz runs test about the middle of the alphabet, and a test of the serial
correlation of neighbouring symbols. Their p-values are combined by the Cauchy rule.

Noise has uniform p-values and prose has tiny ones, so per encoding and length class the
share of prose among the tokens above a cut is estimated from all tokens of the corpus (the
mass above what the uniform part explains). The smallest cut whose estimated share of false
discoveries is at most ``alpha`` is used; a class where none suffices gives no cut.

A clear token needs no others: its own local false-discovery rate is computed from how much better
uniform noise of its encoding explains its characters (case folded) than the character pairs of the
corpus's words do, and from the share of such tokens. One that the tests do not
reject is reported when that rate is at most ``alpha``, however few there are.

Null text counts as empty; repeated rows repeat their result; an empty table gives an empty
result. Columns beside id and text are not read. Spans are in code points, end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from series_lake.llm.staging import staging

# The base patterns and the least length of what they must hold.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "random")

ENCODINGS = {
    "hex": (r"^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", True),
    "base32": (r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", False),
    "lower36": (r"^[a-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz", False),
    "alnum": (r"^[A-Za-z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", False),
    "base64": (r"^[A-Za-z0-9+/_-]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/", False),
}
BINS = 64
# Folded symbols of a token; the last place of a pair table is the start of a word.
FOLDED = "abcdefghijklmnopqrstuvwxyz0123456789+/_-"
#: Counts that a pair's chance borrows from the symbol's, and the symbol's from an even one.
BORROWED = 100.0
#: Evidence from which a token counts as noise in the estimate of their share.
CLEAR_BITS = 20.0


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """array<struct<start, kind, end, match>> of the matches, from the pieces between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint,match:string>>").alias("out"))
    walked = F.aggregate(
        F.zip_with(pieces, found, lambda p, m: F.struct(p.alias("p"), m.alias("m"))),
        state,
        lambda acc, x: F.when(x["m"].isNull(), acc).otherwise(
            F.struct(
                (acc["at"] + F.length(x["p"]) + F.length(x["m"])).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(F.struct((acc["at"] + F.length(x["p"])).alias("start"), F.lit(kind).alias("kind"), (acc["at"] + F.length(x["p"]) + F.length(x["m"])).alias("end"), x["m"].alias("match"))),
                ).alias("out"),
            )
        ),
        lambda acc: acc["out"],
    )
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,match:string>>")
    return F.when(text.rlike(pattern), walked).otherwise(empty)


def _normal_tail(z: Column) -> Column:
    """Two-sided tail of the standard normal, by a rational bound good to 1e-7."""
    x = F.abs(z) / math.sqrt(2.0)
    t = 1 / (1 + 0.5 * x)
    # Chebyshev coefficients of the complementary error function.
    series = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)
    power = F.lit(series[-1])
    for a in reversed(series[:-1]):
        power = a + t * power
    return F.least(F.lit(1.0), t * F.exp(-x * x + power))


def _p_value(tokens: DataFrame) -> DataFrame:
    """Adds enc, n and the combined p-value of the three tests to rows with a ``token``."""
    enc = F.coalesce(*[F.when(F.col("token").rlike(p), F.lit(name)) for name, (p, _, _) in ENCODINGS.items()])
    cases, sizes = [], []
    for name, (_, alphabet, fold) in ENCODINGS.items():
        source = "lower(token)" if fold else "translate(token, '-_', '+/')"
        cases.append(f"WHEN enc = '{name}' THEN transform(filter(split({source}, ''), c -> c <> ''), c -> instr('{alphabet}', c) - 1)")
        sizes.append(f"WHEN enc = '{name}' THEN {len(alphabet)}")
    frame = (
        tokens.withColumn("enc", enc)
        .withColumn("n", F.length("token").cast("double"))
        .withColumn("k", F.expr(f"CASE {' '.join(sizes)} END").cast("double"))
        .withColumn("codes", F.expr(f"CASE {' '.join(cases)} END"))
        .withColumn("low", F.expr("transform(codes, c -> c < k / 2)"))
        .withColumns(
            {
                "squares": F.expr("aggregate(array_distinct(codes), 0D, (a, d) -> a + power(size(filter(codes, c -> c = d)), 2))"),
                "n_low": F.expr("cast(size(filter(low, x -> x)) as double)"),
                "runs": F.expr("cast(1 + size(filter(low, (x, i) -> i > 0 and x <> low[i - 1])) as double)"),
                "mean": F.expr("aggregate(codes, 0D, (a, c) -> a + c) / n"),
            }
        )
        .withColumns(
            {
                "var": F.expr("aggregate(codes, 0D, (a, c) -> a + power(c - mean, 2))"),
                "cov": F.expr("aggregate(transform(codes, (c, i) -> IF(i > 0, (c - mean) * (codes[i - 1] - mean), 0D)), 0D, (a, x) -> a + x)"),
            }
        )
    )
    n, k, low = F.col("n"), F.col("k"), F.col("n_low")
    high = n - low
    chi = F.col("squares") * k / n - n
    chi_z = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n))
    # One-sided: only symbols that are too unequal speak against noise.
    chi_p = F.when(chi_z > 0, _normal_tail(chi_z) / 2).otherwise(1 - _normal_tail(chi_z) / 2)
    expected, spread = 2 * low * high / n + 1, 2 * low * high * (2 * low * high - n) / (n * n * (n - 1))
    # All symbols in one half: the chance of that under noise.
    runs_p = F.when((low == 0) | (high == 0), F.pow(F.lit(2.0), 1 - n)).when(spread > 0, _normal_tail((F.col("runs") - expected) / F.sqrt(spread))).otherwise(F.lit(1.0))
    serial_p = F.when(F.col("var") > 0, _normal_tail((F.col("cov") / F.col("var") + 1 / n) * F.sqrt(n))).otherwise(F.lit(0.0))
    tiny = 1e-12
    cauchy = sum((F.tan((0.5 - F.greatest(F.lit(tiny), F.least(F.lit(1 - tiny), p))) * math.pi) for p in (chi_p, runs_p, serial_p)), F.lit(0.0)) / 3
    return frame.withColumn("p", 0.5 - F.atan(cauchy) / math.pi)


def _prose(docs: DataFrame, text: Column) -> Column:
    """log2 of the chance of each symbol after each in the words of the corpus, as an array.

    A word long enough for a token counts once however often it occurs: a key teaches little.
    """
    size = len(FOLDED)
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9+/_-]+"), F.lit(0))).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n")).withColumn("n", F.when(F.length("word") < 20, F.col("n")).otherwise(1))
    pairs = counted.select("n", F.expr(f"transform(filter(split(word, ''), c -> c <> ''), c -> instr('{FOLDED}', c) - 1)").alias("f"))
    pairs = pairs.select("n", F.expr(f"explode(transform(f, (c, i) -> IF(i > 0, f[i - 1], {size}) * {size} + c))").alias("pair"))
    table = [[0.0] * size for _ in range(size + 1)]
    for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # at most symbols x symbols
        table[r["pair"] // size][r["pair"] % size] = float(r["n"])
    total = sum(map(sum, table))
    single = [(sum(row[c] for row in table) + BORROWED / size) / (total + BORROWED) for c in range(size)]
    return F.lit([math.log2((row[c] + BORROWED * single[c]) / (sum(row) + BORROWED)) for row in table for c in range(size)])


def _noise_bits(prose: Column) -> Column:
    """log2 of how many times likelier the token is as uniform noise than as prose."""
    size = len(FOLDED)
    codes = F.expr(f"transform(filter(split(lower(token), ''), c -> c <> ''), c -> instr('{FOLDED}', c) - 1)")
    before = F.concat(F.array(F.lit(size)), codes)
    as_prose = F.aggregate(F.zip_with(codes, F.slice(before, 1, F.size(codes)), lambda c, b: F.get(prose, b * size + c)), F.lit(0.0), lambda a, x: a + x)
    # Folding joins two symbols of the encodings with both cases.
    folded = F.when(F.col("enc").isin("alnum", "base64"), F.size(F.filter(codes, lambda c: c < 26))).otherwise(0)
    return folded - F.col("n") * F.log2("k") - as_prose


def clear_bits(tokens: int, clear: int, alpha: float) -> float:
    """Least evidence at which a token's local false-discovery rate is at most ``alpha``, where
    ``clear`` of all tokens are noise."""
    share = (clear + 0.5) / (tokens + 1)
    return math.log2((1 - alpha) / alpha * max(1.0, (1 - share) / share))


def _length_class() -> Column:
    return F.expr("CASE WHEN n < 32 THEN 0 WHEN n < 48 THEN 1 WHEN n < 64 THEN 2 ELSE 3 END")


def noise_cuts(histogram: dict[tuple[str, int], list[int]], alpha: float) -> dict[tuple[str, int], float]:
    """Smallest cut per class whose estimated share of prose above it is at most ``alpha``.

    The uniform part is read off the upper half of the p-values; one token is added to the
    estimate of false ones, so a class needs at least 1 / alpha tokens above the cut.
    """
    cuts = {}
    for key, counts in histogram.items():
        uniform = 2 * sum(counts[BINS // 2 :])
        for b in range(1, BINS // 2):
            above = sum(counts[b:])
            false = max(0.0, above - uniform * (1 - b / BINS)) + 1
            if above and false / above <= alpha:
                cuts[key] = b / BINS
                break
    return cuts


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = 0.05) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``base`` and ``added`` spans, each an array of
    struct<start, kind, end, match> in order; ``kind`` indexes KINDS."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    with staging(spark, "secrets") as area:
        read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        assign = F.filter(_spans(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 6)
        found = read.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.array_sort(F.concat(assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2))).alias("base"),
            _spans(text, TOKEN, 3).alias("tokens"),
        )
        rows = area.write(found, keep=True)
        tokens = rows.select("row", "base", F.explode("tokens").alias("span")).select(
            "row", "span", F.col("span.match").alias("token"),
            F.expr("exists(base, b -> b.start < span.end AND span.start < b.end)").alias("known"),
        )
        prose = _prose(read, text)
        tested = area.write(_p_value(tokens).select("row", "span", "known", "enc", _length_class().alias("class"), "p", _noise_bits(prose).alias("bits")), keep=True)
        counts = tested.groupBy("enc", "class", F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")).count()
        histogram: dict[tuple[str, int], list[int]] = {}
        for r in counts.collect():  # at most encodings x length classes x bins
            if r["bin"] is not None:
                histogram.setdefault((r["enc"], r["class"]), [0] * BINS)[r["bin"]] += r["count"]
        accepted = F.lit(False)
        for (enc, cls), cut in noise_cuts(histogram, alpha).items():
            accepted = accepted | ((F.col("enc") == enc) & (F.col("class") == cls) & (F.col("p") >= cut))
        strong = (F.col("p") >= alpha) & (F.col("bits") >= CLEAR_BITS)
        n_tokens, n_clear = tested.agg(F.count("*"), F.count(F.when(strong, True))).first()
        accepted = accepted | ((F.col("p") >= alpha) & (F.col("bits") >= clear_bits(n_tokens, n_clear, alpha)))
        added = tested.where(accepted & ~F.col("known")).groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("added"))
        none = F.array().cast(rows.schema["base"].dataType)
        return rows.join(added, "row", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
