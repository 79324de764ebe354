"""Loading files once, with a ledger of what came out of each.

A load reads the files that the ledger does not know in their present size and modification time,
writes their rows under an id of its own, and then writes an entry per file: rows loaded, rows
rejected, the first reason. The entry is what makes rows count: ``loaded_rows`` reads the rows of
each file's newest entry, so a load that fails before its entries leaves nothing behind that is
read, a file that has changed takes the place of its earlier rows, and a forced reload is exact.
"""

from __future__ import annotations

import math
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from series_lake.sources.files import CORRUPT, PARQUET_FORMAT, scan_if_exists
from series_lake.workspace import staged

#: Files of one round, whose names pass through the driver. More files take more rounds.
ROUND = 10_000
ON_ERROR = ("continue", "skip_file", "abort")
LEDGER = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("first_error", T.StringType()),
        T.StructField("load_id", T.StringType()),
    ]
)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """Every entry ever written; a file has one per load."""
    return scan_if_exists(spark, f"{root}/ledger", LEDGER)


def current_entries(spark: SparkSession, root: str) -> DataFrame:
    """The newest entry of each file."""
    rest = [n for n in LEDGER.names if n not in ("file", "load_id")]
    newest = ledger(spark, root).groupBy("file").agg(F.max(F.struct("load_id", *rest)).alias("e"))
    return newest.select("file", *[F.col(f"e.{c}").alias(c) for c in rest], F.col("e.load_id").alias("load_id"))


def loaded_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows that count, in the columns of ``schema``."""
    laid = T.StructType([*schema.fields, T.StructField("_file", T.StringType()), T.StructField("load_id", T.StringType())])
    entries = current_entries(spark, root).where("rows_loaded > 0").select(F.col("file").alias("_of"), F.col("load_id").alias("_by"))
    rows = scan_if_exists(spark, f"{root}/rows", laid)
    return rows.join(entries, (F.col("_file") == F.col("_of")) & (F.col("load_id") == F.col("_by")), "left_semi").select(*schema.names)


def _present(spark: SparkSession, source: str) -> DataFrame:
    """The files under a path. Their contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    meta = lambda name: F.col(f"_metadata.{name}")
    return listed.select(meta("file_path").alias("file"), meta("file_size").alias("size"), meta("file_modification_time").alias("modified"))


def load_new_files(
    spark: SparkSession, source: str, schema: T.StructType, root: str, form: str = "json", required: tuple[str, ...] = (),
    on_error: str = "continue", force: bool = False, files_per_round: int = ROUND,
) -> DataFrame:
    """Load the files under ``source`` that are new or changed; all of them with ``force``.

    Rejected are rows that cannot be parsed and rows without a value in a ``required`` column.
    ``on_error``: "continue" loads a file's other rows, "skip_file" loads none of a file with a
    rejected row, "abort" ends the load before anything of its round is written. Returns the
    entries of this load.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}, not {on_error!r}")
    load = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    with staged(spark, "files") as files_at:
        found = _present(spark, source)
        if not force:
            known = current_entries(spark, root).select(*[F.col(c).alias(f"_{c}") for c in ("file", "size", "modified")])
            same = [F.col(c) == F.col(f"_{c}") for c in ("file", "size", "modified")]
            found = found.join(known, same[0] & same[1] & same[2], "left_anti")
        found.write.parquet(files_at)
        fresh = spark.read.schema(T.StructType(LEDGER.fields[:3])).parquet(files_at)
        rounds = math.ceil(fresh.count() / files_per_round)
        for number in range(rounds):
            part = fresh.where(F.pmod(F.xxhash64("file"), F.lit(rounds)) == number)
            _load_round(spark, part, schema, root, form, required, on_error, f"{load}-{number:06d}")
    return ledger(spark, root).where(F.col("load_id").startswith(load))


def _fault(required: tuple[str, ...], captured: bool) -> Column:
    """Why a row is rejected; NULL where it is not."""
    faults = [F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in required]
    if captured:
        faults.insert(0, F.when(F.col(CORRUPT).isNotNull(), F.concat(F.lit("unreadable: "), F.substring(CORRUPT, 1, 200))))
    return F.coalesce(*faults, F.lit(None).cast("string"))


def _load_round(spark: SparkSession, part: DataFrame, schema: T.StructType, root: str, form: str, required: tuple[str, ...], on_error: str, load_id: str) -> None:
    paths = [r.file for r in part.select("file").collect()]  # about ``files_per_round``
    if not paths:
        return
    captured = form == "json"
    read_as = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if captured else schema
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT} if captured else {}
    read = spark.read.schema(read_as).options(**options).format(form).load(paths)
    told = read.select(*read_as.names, F.col("_metadata.file_path").alias("_file")).withColumn("_fault", _fault(required, captured))
    with staged(spark, "counts") as counts_at:
        good = F.col("_fault").isNull()
        filled = F.count(schema.names[0]).alias("filled")  # a text file is not parsed for its unreadable lines alone
        told.groupBy("_file").agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"), F.min("_fault").alias("first"), filled).write.parquet(counts_at)
        counts = spark.read.schema("_file string, good long, bad long, first string").parquet(counts_at)
        if on_error == "abort":
            worst = counts.where("bad > 0").orderBy("_file").first()
            if worst is not None:
                raise ValueError(f"{worst['bad']} rejected rows in {worst['_file']}: {worst['first']}")
        rows = told.where(good).select(*schema.names, "_file").withColumn("load_id", F.lit(load_id))
        if on_error == "skip_file":
            faulty = counts.where("bad > 0").select(F.col("_file").alias("_of"))
            rows = rows.join(faulty, F.col("_file") == F.col("_of"), "left_anti")
        rows.write.mode("append").options(**PARQUET_FORMAT).partitionBy("load_id").parquet(f"{root}/rows")
        joined = part.join(counts, F.col("file") == F.col("_file"), "left").fillna(0, ["good", "bad"])
        kept = F.when((F.col("bad") > 0) & F.lit(on_error == "skip_file"), F.lit(0)).otherwise(F.col("good"))
        status = F.when(F.col("bad") == 0, "LOADED").when(F.col("rows_loaded") > 0, "PARTIALLY_LOADED").otherwise("LOAD_FAILED")
        entries = joined.withColumn("rows_loaded", kept.cast("bigint")).withColumn("status", status).withColumn("load_id", F.lit(load_id))
        entries = entries.withColumn("rows_rejected", F.col("bad")).withColumn("first_error", F.col("first"))
        entries.select(*LEDGER.names).coalesce(1).write.mode("append").parquet(f"{root}/ledger")
