"""traitlab: audience attribute inference as Spark DataFrame jobs.

Sub-packages: ``sources`` (tables, derived input views, dated scans, sinks),
``functions`` (column helpers), ``operators`` (catalog, features, labels,
dataset, model, metrics), ``plans`` (jobs and registered queries) and
``streaming`` (empty on purpose: the jobs are daily batches).
"""

__all__ = ["constants", "session"]
