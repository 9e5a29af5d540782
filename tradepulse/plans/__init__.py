"""The query catalogue: each entry pairs a Spark query with its SQL check."""
