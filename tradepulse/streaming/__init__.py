"""The foreachBatch job, its tables and the bounded late match."""
