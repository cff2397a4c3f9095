"""Operators for large training-data pipelines (text, web archives, vectors).

Every module holds one operator with a general interface plus the thin ``opN_`` query
that applies it to its table. Nothing outside this subpackage imports it.
"""
