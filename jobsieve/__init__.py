"""Incremental posting analytics on Spark: discover, filter, rank, dedup, report and notify, expressed as DataFrame plans."""
