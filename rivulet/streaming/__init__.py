"""Structured Streaming sources and foreachBatch writers."""
