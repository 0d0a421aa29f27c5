"""Order analytics on Spark: typed sources, cleaning, marts, reports, sinks."""
