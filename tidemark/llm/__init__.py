"""Operators for preparing training text at scale.

Operators, each a function from DataFrames to DataFrames, plus the thin
``opN_*`` queries built on them (``queries``).  Nothing outside this package
imports it.
"""
