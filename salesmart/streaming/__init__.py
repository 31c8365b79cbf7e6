"""The refresh procedure (import new order lines, reload, check) as a
Structured Streaming file source with ``foreachBatch``."""
