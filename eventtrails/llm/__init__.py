"""Operators for training-data corpora: one module each, plus their queries.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
