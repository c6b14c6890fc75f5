"""Operators for building text corpora: filtering, deduplication, packing and scans.

Nothing outside this package imports it.  Every operator takes and returns
DataFrames; :mod:`recordloom.llm.queries` holds the registered queries.
"""
