"""Raw documents, published Parquet, stages and market listings."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from series_lake.functions.choice import choice_double, element_type
from series_lake.schemas import DESCRIPTIVE, FLAT_DATED, LANDED, LEG_ARRAYS, MARKETS, RAW, RAW_TYPED

CORRUPT = "_corrupt_record"
# The named file format. Binary columns stay binary, which is what
# spark.sql.parquet.binaryAsString=false (the default, and set in session.py) does.
PARQUET_FORMAT = {"compression": "snappy"}


def scan_raw(spark: SparkSession, path: str, schema: T.StructType = RAW) -> DataFrame:
    """One document per JSON line (see ``scan_corrupt_capture`` for unreadable lines). Folders of
    the landing layout are not columns of the documents."""
    return spark.read.schema(schema).json(path).select(*schema.names)


def scan_raw_table(spark: SparkSession, name: str) -> DataFrame:
    """Raw documents registered in the catalog."""
    return spark.table(name)


def typed_copy(spark: SparkSession, raw: DataFrame, path: str) -> DataFrame:
    """A columnar copy of raw documents with numeric pairs.

    Worth it where the documents are read more than once: JSON is parsed whole every time,
    the copy is pruned to one array per read.
    """
    dtype = element_type(raw)

    def pairs(array: str) -> Column:
        return F.transform(
            f"data.{array}", lambda pair: F.transform(pair, lambda value: choice_double(value, dtype))
        ).alias(array)

    data = F.when(F.col("data").isNotNull(), F.struct(*[pairs(a) for a in LEG_ARRAYS.values()])).alias("data")
    segment = [f for f in LANDED if f.name == "segment" and f.name in raw.columns]
    raw.select("coin_id", *DESCRIPTIVE, data, *[f.name for f in segment]).write.options(**PARQUET_FORMAT).parquet(path)
    return spark.read.schema(T.StructType([*RAW_TYPED.fields, *segment])).parquet(path)


def scan_corrupt_capture(spark: SparkSession, path: str, schema: T.StructType = RAW, fail_fast: bool = False) -> DataFrame:
    """Documents plus the text of those that could not be parsed; or abort on the first."""
    if fail_fast:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    captured = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(captured).options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    return reader.json(path).select(*captured.names)


def scan_published(spark: SparkSession, path: str, schema: T.StructType = FLAT_DATED) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def scan_if_exists(spark: SparkSession, path: str, schema: T.StructType = FLAT_DATED, form: str = "parquet") -> DataFrame:
    """The snapshot at a path, or an empty frame when nothing was written there yet.

    Only "path not found" counts as absent. Any other failure (no permission, service
    down) is raised: taking it for an empty history would overwrite the real one.
    """
    try:
        return spark.read.schema(schema).format(form).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_stage(spark: SparkSession, path: str) -> DataFrame:
    """A directory of Parquet files with whatever columns they have."""
    return spark.read.parquet(path)


def markets_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Landed market listings."""
    return spark.read.schema(MARKETS).json(path)
