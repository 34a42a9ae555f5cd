"""Operators of a training-data pipeline: tokenizers, filters, near-duplicate search, mixing, nearest neighbours.

Nothing outside this subpackage (but the driver entry and ``corpus_pipeline.py``) imports it.
"""
