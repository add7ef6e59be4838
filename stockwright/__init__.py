"""Retail inventory analytics on Spark: pure DataFrame functions, batch and streaming."""
