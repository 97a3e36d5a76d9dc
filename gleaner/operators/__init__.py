"""DataFrame operators; every one is built from Spark expressions, joins,
aggregates and windows."""
