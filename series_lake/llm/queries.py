"""The operators as queries over the given tables, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from series_lake.llm import pii_crf, secrets
from series_lake.llm.decontamination import find_passages
from series_lake.llm.html_templates import main_text
from series_lake.llm.language import held_out, identify, learn
from series_lake.llm.line_dedup import EVERY_LINE, dedup_lines
from series_lake.llm.mixing import mix_counts
from series_lake.llm.ngram_join import Join, near_duplicates
from series_lake.llm.packing import pack
from series_lake.llm.periodic_runs import periodic_runs, run_text, strongest
from series_lake.llm.pii_crf import find_personal
from series_lake.llm.quality import STOP_WORDS, quality_rules
from series_lake.llm.secrets import scan_secrets
from series_lake.llm.topk import search
from series_lake.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Three words, 100 * common >= 90 * all. The recursion is the plain definition of a component.
OP1_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))) END AS shingles
    FROM w
), e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS i
    FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM common WHERE 100 * i >= 90 * (na + nb - i)
    UNION ALL SELECT b, a FROM common WHERE 100 * i >= 90 * (na + nb - i)
), reach AS (
    SELECT doc_id, doc_id AS other FROM s UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT s.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, (SELECT min(other) FROM reach WHERE reach.doc_id = s.doc_id) AS component_id
FROM s
"""


@query("op1_ngram_join", OP1_SQL)
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Join(width=3, num=90, den=100))


@query("op2_html_templates")
def op2_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).select("page_id", "url", F.col("text").cast("string"), "n_chars")


@query(
    "op3_exact_topk",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    WHERE rank <= 10
    """,
)
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def kind_counts(spans: str | Column, kinds: tuple[str, ...]) -> list[Column]:
    """The number of spans of each kind, as ``n_<kind>``."""

    def of_kind(k: int) -> Callable[[Column], Column]:
        return lambda s: s["kind"] == k  # one argument: a second one would get the place in the array

    return [F.size(F.filter(spans, of_kind(k))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(kinds)]


@query("op4_pii_crf")
def op4_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *kind_counts(base, pii_crf.KINDS), F.sha2(pii_crf.span_text(base), 256).alias("base_sha256"), pii_crf.span_text(F.col("spans")).alias("spans"))


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    everything = F.array_sort(F.concat("base", "added"))
    return found.select("doc_id", *kind_counts("base", secrets.KINDS[:3]), F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"), secrets.span_text(everything).alias("spans"))


#: The rules of ``quality.RULES`` once more, as SQL.
OP6_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
    SELECT row, doc_id, text,
        list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM t
), windows AS (
    SELECT row, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
    FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), twice AS (
    SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, a, b, c) AS n FROM windows) WHERE n > 1
), repeated AS (
    SELECT row, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row
), m AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
        length(regexp_replace(text, '\P{L}', '', 'g')) AS letters, length(regexp_replace(text, '\P{Lu}', '', 'g')) AS upper,
        length(regexp_replace(text, '[^!?]', '', 'g')) AS exclaim,
        len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) AS letter_words,
        len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•‣◦]'))) AS bullets,
        len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09\x0D]*$'))) AS ellipses,
        len(list_intersect(list_transform(words, lambda x: lower(x)), {stop_words})) AS stop_words
    FROM w LEFT JOIN repeated USING (row)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
        OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR n_symbols > 0.1::DOUBLE * n_words
        OR letter_words / n_words < 0.7::DOUBLE OR (letters > 0 AND upper / letters > 0.4::DOUBLE)
        OR exclaim / n_words > 0.3::DOUBLE OR (n_lines > 0 AND (bullets / n_lines > 0.9::DOUBLE
            OR ellipses / n_lines > 0.3::DOUBLE OR n_dup_lines / n_lines > 0.5::DOUBLE))
        OR stop_words < 2) AS kept
FROM m
""".replace("{stop_words}", "[" + ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS)) + "]")  # fmt: skip


@query("op6_quality_rules", OP6_SQL)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality_rules(table(spark, sf_dir, "documents"))
    return rules.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_line_minhash")
def op7_line_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), EVERY_LINE)


@query("op8_language_mixture")
def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = identify(docs, learn(docs), ["doc_id"])
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__lang_pred").alias("lang_pred"), F.col("__lang_score").alias("score"))


@query("op9_source_mixing")
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op10_bin_slack_packing")
def op10_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def repeating(text: Column, doc_id: Column) -> Column:
    """The text whose words from a place on repeat a block, both given by a checksum of the id; only
    every tenth id, and a text without words or id, is changed at all."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(words)
    first = F.pmod(g, n).cast("int")
    period = (F.lit(1) + F.floor((n - first) / (F.lit(3) + g % 8))).cast("int")
    block = F.slice(words, first + 1, period)
    # one block more than the tail needs, cut to the tail's length
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil((n - first) / period).cast("int"))), F.lit(1), n - first)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), first), tail), " ")
    return F.when((h % 10 == 0) & (n > 0), changed).otherwise(text)


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs, ["doc_id"], repeating(F.col("text"), F.col("doc_id")))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(run_text(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), components=8)


#: Windows are compared as texts of words joined by a space; a text never holds an item's words
#: across others, so equal texts are equal windows.
OP13_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), starts AS (
    SELECT item, words, least(10, len(words)) AS size, unnest(range(1, greatest(2, len(words) - 8))) AS i FROM b WHERE len(words) > 0
), w AS (
    SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS gram FROM starts
), places AS (
    SELECT row, size, i, array_to_string(words[i:i + size - 1], ' ') AS gram
    FROM (SELECT row, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM w))
), hits AS (SELECT row, item, w.size, i FROM places JOIN w ON places.size = w.size AND places.gram = w.gram),
covered AS (SELECT row, count(DISTINCT k) AS n FROM (SELECT row, unnest(range(i, i + size)) AS k FROM hits) GROUP BY row),
items AS (SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS told FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
    sha256(coalesce(told, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (row) LEFT JOIN items USING (row)
"""


@query("op13_decontamination", OP13_SQL)
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
