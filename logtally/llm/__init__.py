"""Operators of a training-data pipeline over documents and pages.

Every operator takes and returns DataFrames. Nothing outside this folder
imports it except the guarded lines of ``__spark_entry__.py`` and
``corpus_pipeline.py``.
"""
