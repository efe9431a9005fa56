"""Operators for preparing training corpora, and their queries.

Nothing outside this package imports it. The queries are in :mod:`eventloom.llm.queries`.
"""
