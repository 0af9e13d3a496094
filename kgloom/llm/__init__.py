"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage; the queries that use it
are registered by ``kgloom.llm.queries``.
"""
