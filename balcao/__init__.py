"""Sales analytics on Spark: layered tables, baskets, customer snapshots and checks."""
