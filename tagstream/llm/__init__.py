"""Operators of a training-data pipeline over documents and web pages.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
