"""Incremental delivery analytics on Spark: owed sets, gates, best-of, report shaping and delivery state."""
