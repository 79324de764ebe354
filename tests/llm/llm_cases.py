"""Small tables with every odd case, shared by the tests of this folder."""

import random

PROSE = {
    "en": "the of and to in is that for was with on are this from by they have not but which were their been has more when who will would there people time could first water long".split(),
    "de": "der die und das nicht ein eine ist von zu mit sich auf für dem den auch werden über noch wenn zwischen können müssen straße größe während natürlich schließlich möglich".split(),
    "fr": "le la les des une est que qui dans pour avec être pas plus nous vous cette même après très été où déjà français première année être aussi façon général été".split(),
}


def prose(rng, lang, n):
    words = []
    while len(words) < n:
        words += [rng.choice(PROSE[lang]) + rng.choice(["", "", "s", "er"]) for _ in range(min(12, n - len(words)))]
    return "\n".join(" ".join(words[i : i + 60]).capitalize() + "." for i in range(0, n, 60))


def documents():
    """(doc_id, text, lang, source): prose, exact and near copies, and the odd cases."""
    rng = random.Random(4)
    rows = []
    for i in range(60):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, prose(rng, lang, rng.randrange(60, 400)), lang, f"s{i % 4}"))
    base = rows[0][1].split(" ")
    for i in range(60, 80):  # near copies of document 0, each with a few words of its own
        words = list(base)
        for k in rng.sample(range(len(words)), i % 5):
            words[k] = f"w{i}x{k}"
        rows.append((i, " ".join(words), "en", "s0"))
    rows += [
        (80, rows[3][1], "en", "s1"),
        (81, rows[3][1].upper(), None, None),
        (82, None, "en", "s0"),
        (83, "", "en", None),
        (84, " \t\n\x0b ", None, "s0"),
        (85, "one", "en", "s0"),
        (86, "ONE", "de", "s0"),
        (87, "a b c d e f g h i j k", "en", "s2"),
        (88, "12 34 !! 56", None, "s2"),
        (None, rows[5][1], "de", "s0"),
        (None, "alone here", "en", None),
        (90, "x" * 150_000, "en", "s3"),
        (91, "ab " * 60_000, "en", "s3"),
        (92, prose(rng, "en", 3000), "en", "s3"),
        (92, prose(rng, "fr", 50), "fr", "s3"),
    ]
    rows += [rows[7]] * 3
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that the operators use inside.
CLASHES = ["node", "sig", "label", "n", "kind", "row", "gone", "hits", "task", "length", "spans", "score", "bucket", "key"]


def frame(spark, rows=None, clashes=True):
    table = spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)
    if clashes:
        from pyspark.sql import functions as F

        table = table.withColumns({c: F.lit(1) for c in CLASHES})
    return table
