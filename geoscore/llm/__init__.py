"""Operators of a training-data pipeline over the document and vector tables.

Each ``opN_*`` module of :mod:`geoscore.llm.queries` is a thin registered
query; the operators themselves are general DataFrame functions.
"""
