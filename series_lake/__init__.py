"""Per-asset time series on Spark: flatten, merge, publish, load, measure."""
