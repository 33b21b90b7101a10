"""Batch and streaming analytics over motor-racing timing data, on Spark."""
