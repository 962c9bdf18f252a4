"""Batch and streaming data pipelines on Spark: loads, staging, marts, checks, stream landing."""
