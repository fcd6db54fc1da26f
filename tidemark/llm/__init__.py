"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it.  Each module holds one operator
with a general interface and the thin ``opN_*`` query built on it.
"""
