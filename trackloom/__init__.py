"""trackloom: a Spark-first engine for time-stamped, spatial and track-structured data."""
