"""Operators of a training-data pipeline, one module each.

Nothing outside this package and ``corpus_pipeline.py`` imports it. Every operator takes a
table with ``doc_id`` and ``text`` (further columns are ignored or carried, never read by
name), partitions its work through Spark and keeps only bounded state on the driver.
"""
