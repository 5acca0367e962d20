"""Whole flows from source tables to batches, shards and reports."""
