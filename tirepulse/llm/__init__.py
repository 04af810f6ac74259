"""Operators for preparing training text, each built on Spark DataFrames.

Nothing outside this folder (but for the guarded registration in
``__spark_entry__.py`` and ``corpus_pipeline.py``) imports it.
"""
