"""Road-toll traffic analytics on Spark: loading, reports and classification."""
