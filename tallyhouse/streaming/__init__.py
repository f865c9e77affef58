"""Structured Streaming forms of the append loop and the daily rollup."""
