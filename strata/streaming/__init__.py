"""Structured Streaming jobs: bounded drains of landed messages and change
streams, each micro-batch applied with ``foreachBatch``."""
