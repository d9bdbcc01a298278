"""Operators for preparing language-model training data.

Nothing outside this folder imports it.  Each module holds one operator with its
general interface plus the thin ``opN_`` query that ``queries.py`` registers.
"""
