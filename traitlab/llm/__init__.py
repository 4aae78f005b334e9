"""Corpus preparation operators for training-data pipelines.

One module per operator; ``queries.py`` registers one query per operator and
its DuckDB statement. Nothing outside this subpackage imports it except the
guarded registration in ``__spark_entry__.py``.
"""
