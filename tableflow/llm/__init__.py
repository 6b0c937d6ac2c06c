"""Operators for preparing training corpora, one module each.

Nothing outside this package imports it; ``queries.py`` holds the
registered queries and ``oracles.py`` their SQL.
"""
