from urllib.parse import urlparse

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from series_lake.functions import casts, text
from series_lake.functions.documents import path_value, row_object
from series_lake.operators.filters import insert_columns, lookback, quoted_in
from series_lake.schemas import WH_HIST
from series_lake.functions.timeconv import DAY_MS
from series_lake.workspace import scratch, shared_root


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("name", ["intra_day", "normal", "run_2x_fast", "", "o'neil_x", "ÉCOLE_été", "4-NOT SPECIFIED"])
def test_title(spark, name):
    assert one(spark, text.title_text(F.lit(name))) == name.replace("_", " ").title()


@pytest.mark.parametrize(
    "uri", ["s3://bucket/a/b/", "s3://bucket", "s3://b//double/x", "https://user@h:8080/p/q?x=1#f", "http://h?q", "/only/path", "plain"]
)
def test_uri(spark, uri):
    parsed = urlparse(uri)
    assert one(spark, text.uri_bucket(F.lit(uri))) == parsed.netloc
    assert one(spark, text.uri_key(F.lit(uri))) == parsed.path.lstrip("/")


def test_routing(spark):
    frame = spark.createDataFrame([("intra_day",), ("normal",), (None,), ("INTRA_DAY",)], "t string")
    got = frame.select(text.target_prefix(F.col("t")), text.lookback_days(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("intra_day_data", 1)] + [("historical_data", 365)] * 3
    assert one(spark, text.object_key(F.lit("intra_day"), F.lit("btc"))) == "intra_day_data/btc.json"
    assert one(spark, text.path_prefix(F.lit("intra_day_data/btc.json"))) == "intra_day_data"


def test_casts(spark):
    assert [one(spark, casts.as_number(F.lit(x))) for x in (2.5, -2.5, 1e20)] == [3, -3, 10**20]
    assert one(spark, casts.as_float(F.lit("x"))) is None
    assert str(one(spark, casts.at_precision(F.lit(1.005).cast("decimal(9,3)")))) == "1.01"
    assert one(spark, casts.at_precision(F.lit(2.346))) == 2.35


def test_row_paths_are_case_sensitive(spark):
    frame = spark.createDataFrame([(1.5, "a")], "market_cap double, coin_id string")
    row = row_object(frame)
    got = frame.select(path_value(row, "market_cap", "double"), path_value(row, "MARKET_CAP", "double"), path_value(row, "coin_id", "double")).first()
    assert tuple(got) == (1.5, None, None)


def test_insert_columns(spark):
    row = insert_columns(spark.createDataFrame([("a",)], "id string"), WH_HIST)
    assert row.columns == WH_HIST.names and row.first().current_price is None
    with pytest.raises(ValueError):
        insert_columns(spark.createDataFrame([("a",)], "other string"), WH_HIST)


def test_lookback_prunes_partitions(spark, tmp_path):
    rows = spark.range(400).select((F.col("id") * DAY_MS).alias("timestamp"), F.date_from_unix_date(F.col("id").cast("int")).alias("date"))
    rows.write.partitionBy("date").parquet(str(tmp_path / "p"))
    kept = lookback(spark.read.schema("timestamp long, date date").parquet(str(tmp_path / "p")), 399 * DAY_MS, "intra_day")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp," in plan
    assert "PartitionFilters: [isnotnull(date" in plan
    assert kept.count() == 2
    assert lookback(rows, 399 * DAY_MS, "normal").count() == 366


def test_quote_filter(spark):
    frame = spark.createDataFrame([("usd",), ("eur",), (None,)], "q string")
    assert quoted_in(frame, "q", "usd").count() == 1
    with pytest.raises(AnalysisException):
        quoted_in(frame, "none", "usd").count()


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch(spark, "x").startswith(shared_root(spark)) and scratch(spark, "x") != scratch(spark, "x")
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
