"""Short-stay marketplace analytics on Spark: clean, gate, publish, query, measure."""
