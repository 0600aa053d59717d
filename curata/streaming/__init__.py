"""Structured Streaming: file streams and micro-batch loads that reuse the
batch operators inside foreachBatch."""
