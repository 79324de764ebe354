"""Sinks: publish, land, and load into the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from series_lake.functions.documents import build_envelope
from series_lake.operators import metrics
from series_lake.operators.flatten import flatten_series, leg_points, tagged_points
from series_lake.operators.merge import merge_history
from series_lake.queries.projections import new_table
from series_lake.queries.registry import (
    DAILY_SQL,
    DAY_SQL,
    FLAT_SQL,
    HISTORY_SQL,
    MARKETS_SQL,
    MERGED_SQL,
    SERIES_SQL,
    WH_HIST_SELECT,
    WH_INTRA_SELECT,
    query,
)
from series_lake.queries.scans import leg_rows_sql
from series_lake.schemas import FLAT, FLAT_DATED, KEY, LEGS, WH_HIST, WH_INTRA
from series_lake.sinks import bucketed, current, ledger, located, publish, ranked, warehouse
from series_lake.sources.files import scan_raw
from series_lake.sources.tables import (
    daily_points,
    documents,
    existing_history,
    incoming_history,
    landed_documents,
    markets,
    series,
)
from series_lake.workspace import scratch

_WEEK_START_MS = 1_706_054_400_000  # 2024-01-24 00:00:00 UTC


@query("publish_intra_day", f"WITH {FLAT_SQL} SELECT * FROM flat")
def publish_intra_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, root = new_table(spark, "intra_day")
    publish.publish_intra_day(spark, existing_history(spark, sf_dir), name, root)
    return publish.publish_intra_day(spark, flatten_series(landed_documents(spark, sf_dir)), name, root)


@query("publish_historical", f"WITH {MERGED_SQL} SELECT *, {DAY_SQL} FROM merged")
def publish_historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "history")
    publish.publish_history(spark, existing_history(spark, sf_dir), path)
    return publish.publish_history(spark, incoming_history(spark, sf_dir), path)


@query(
    "land_raw",
    f"""WITH {DAILY_SQL}, recent AS (SELECT DISTINCT coin_id AS r FROM daily WHERE "timestamp" >= {_WEEK_START_MS})
{leg_rows_sql(f'("timestamp" >= {_WEEK_START_MS} OR NOT EXISTS (SELECT 1 FROM recent WHERE r = coin_id))')}""",
)
def land_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, then the last week's again: those replace, the others stay."""
    path = scratch(spark, "landing")
    publish.land_bulk(spark, documents(spark, sf_dir, "variant"), path, "normal")
    recent = daily_points(spark, sf_dir).where(F.col("timestamp") >= _WEEK_START_MS)
    publish.land_bulk(spark, build_envelope(recent, "variant"), path, "normal")
    return tagged_points(scan_raw(spark, f"{path}/prefix=historical_data"))


@query(
    "create_tables",
    f"""WITH {SERIES_SQL}
SELECT 'historical' AS table_name, id, current_price, last_updated FROM (SELECT {WH_HIST_SELECT} FROM series)
UNION ALL
SELECT 'intra_day', id, current_price, last_updated FROM (SELECT {WH_INTRA_SELECT} FROM series)""",
)
def create_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = series(spark, sf_dir)
    shown = []
    for label, schema, mapping in (
        ("historical", WH_HIST, warehouse.map_hist),
        ("intra_day", WH_INTRA, warehouse.map_intra),
    ):
        name, location = new_table(spark, label)
        warehouse.create_table(spark, name, schema, location)
        mapping(flat).write.insertInto(name)
        shown.append(spark.table(name).select(F.lit(label).alias("table_name"), "id", "current_price", "last_updated"))
    return shown[0].unionByName(shown[1])


@query("full_reload", f"WITH {MERGED_SQL} SELECT {WH_HIST_SELECT} FROM merged")
def full_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, root = new_table(spark, "reload")
    existing = existing_history(spark, sf_dir)
    warehouse.full_reload(spark, warehouse.map_hist(existing), name, root, WH_HIST)
    merged = merge_history(incoming_history(spark, sf_dir), existing)
    return warehouse.full_reload(spark, warehouse.map_hist(merged), name, root, WH_HIST)


@query("copy_into_hist", f"WITH {SERIES_SQL} SELECT {WH_HIST_SELECT} FROM series")
def copy_into_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.map_hist(series(spark, sf_dir))


@query(
    "copy_into_hist_full",
    f"WITH {SERIES_SQL} SELECT {WH_HIST_SELECT.replace('CAST(NULL AS DOUBLE) AS total_volume', 'volume AS total_volume')} FROM series",
)
def copy_into_hist_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.map_hist(series(spark, sf_dir), full=True)


@query("copy_into_intra", f"WITH {SERIES_SQL} SELECT {WH_INTRA_SELECT} FROM series")
def copy_into_intra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.map_intra(series(spark, sf_dir))


def _metric_sql(select: str, metrics: dict[str, str]) -> str:
    for name, expression in metrics.items():
        select = select.replace(f"CAST(NULL AS DOUBLE) AS {name}", f"{expression} AS {name}")
    return f"""WITH {SERIES_SQL} SELECT {select} FROM series
WINDOW day AS (PARTITION BY coin_id ORDER BY "timestamp" RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW),
  so_far AS (PARTITION BY coin_id ORDER BY "timestamp" RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query(
    "copy_into_hist_metrics",
    _metric_sql(
        WH_HIST_SELECT,
        {
            "high_24h": "max(price) OVER day",
            "low_24h": "min(price) OVER day",
            "price_change_24h": "price - first_value(price) OVER day",
        },
    ),
)
def copy_into_hist_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.map_hist(metrics.rolling_24h(series(spark, sf_dir)))


@query(
    "copy_into_intra_metrics",
    _metric_sql(
        WH_INTRA_SELECT,
        {
            "price_change_percentage_24h": """CASE WHEN first_value(price) OVER day <> 0
    THEN (price - first_value(price) OVER day) * 100 / first_value(price) OVER day END""",
            "circulating_supply": "CASE WHEN price <> 0 THEN market_cap / price END",
            "ath": "max(price) OVER so_far",
            "atl": "min(price) OVER so_far",
        },
    ),
)
def copy_into_intra_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.map_intra(metrics.circulating_supply(metrics.price_metrics(series(spark, sf_dir))))


@query(
    "incremental_load",
    f"WITH {MERGED_SQL} SELECT {WH_HIST_SELECT} FROM merged",
)
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load, publish a run that overlaps by five days, load what changed, and load nothing new."""
    published, target, checkpoint = (scratch(spark, label) for label in ("published", "loaded", "progress"))

    def load() -> DataFrame:
        return warehouse.incremental_load(
            spark, published, FLAT_DATED, warehouse.map_hist, target, WH_HIST, checkpoint
        )

    publish.publish_history(spark, existing_history(spark, sf_dir), published)
    load()
    publish.publish_history(spark, incoming_history(spark, sf_dir), published)
    load()
    return load()


@query("publish_located", f"WITH {MERGED_SQL} SELECT *, {DAY_SQL} FROM merged")
def publish_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that overlap by five days, merged into a table whose days are swapped in the catalog."""
    name, root = new_table(spark, "located")
    for run in (existing_history(spark, sf_dir), incoming_history(spark, sf_dir)):
        located.publish_located(spark, run, name, root)
    return spark.table(name)


@query(
    "load_with_ledger",
    f"""WITH {HISTORY_SQL}
SELECT * FROM existing UNION ALL SELECT * FROM incoming""",
)
def load_with_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of files, each loaded twice, then everything loaded again by force."""
    arriving, root = scratch(spark, "arriving"), scratch(spark, "loaded")
    for run in (existing_history(spark, sf_dir), incoming_history(spark, sf_dir)):
        run.write.mode("append").parquet(arriving)
        for _ in range(2):
            ledger.load_new_files(spark, arriving, FLAT, root, form="parquet", required=tuple(KEY))
    ledger.load_new_files(spark, arriving, FLAT, root, form="parquet", required=tuple(KEY), force=True)
    return ledger.loaded_rows(spark, root, FLAT)


@query("merge_bucketed", f"WITH {MERGED_SQL} SELECT *, {DAY_SQL} FROM merged")
def merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that overlap by five days, merged bucket by bucket."""
    name, root = new_table(spark, "bucketed")
    for run in (existing_history(spark, sf_dir), incoming_history(spark, sf_dir)):
        bucketed.merge_bucketed(spark, run, name, root, buckets=8)
    return spark.table(name)


@query("join_bucketed", f"WITH {FLAT_SQL} SELECT * EXCLUDE (date_time) FROM flat")
def join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three legs, each written as a bucketed table, joined without an exchange."""
    tables = {}
    for leg in LEGS:
        name, root = new_table(spark, leg)
        points = leg_points(landed_documents(spark, sf_dir), leg)
        fields = [f for f in FLAT.fields if f.name in points.columns]
        bucketed.create_bucketed(spark, name, root, StructType(fields), buckets=8)
        bucketed.write_bucketed(spark, points, name, buckets=8)
        tables[leg] = name
    return bucketed.join_bucketed(spark, tables).select(*[c for c in FLAT.names if c != "date_time"])


@query(
    "latest_snapshot_upsert",
    f"""WITH {MERGED_SQL}
SELECT * FROM merged QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY "timestamp" DESC) = 1""",
)
def latest_snapshot_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of each asset after three runs, kept without reading a history."""
    path = scratch(spark, "current")
    for run in (existing_history(spark, sf_dir), incoming_history(spark, sf_dir), existing_history(spark, sf_dir).limit(0)):
        current.upsert_current(spark, run, path)
    return current.read_current(spark, path)


@query(
    "page_from_snapshot",
    f"""WITH {MARKETS_SQL}
SELECT id, name, symbol, image, market_cap, row_number() OVER (ORDER BY market_cap DESC NULLS LAST, id) AS position
FROM markets ORDER BY position LIMIT 25 OFFSET 25""",
)
def page_from_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of a listing that is laid out by rank."""
    listing = markets(spark, sf_dir)
    version = ranked.publish_ranked(listing, scratch(spark, "ranked"))
    return ranked.read_page(spark, version, listing.schema, 2)
