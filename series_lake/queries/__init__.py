"""Every operator as a query over the given tables."""

from series_lake.queries import joins, loads, merging, metrics, projections, quality, ranking, runs, scalars, scans, streams  # noqa: F401
from series_lake.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
