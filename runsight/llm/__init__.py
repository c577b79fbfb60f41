"""Operators of a training-data pipeline over documents and web pages.

Nothing outside this package imports it; ``queries`` registers one query per
operator and ``corpus_pipeline.py`` (repository top) chains five of them.
"""
