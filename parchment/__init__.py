"""Register analytics on Spark: text collections to linked, quality-checked records."""
