"""Operators for preparing training text at scale.

Every operator takes and returns DataFrames and keeps a general interface; the thin registered
queries are in ``queries``. Nothing outside this subpackage imports it.
"""
