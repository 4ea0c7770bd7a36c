"""Time-series market analytics as declarative Spark plans."""
