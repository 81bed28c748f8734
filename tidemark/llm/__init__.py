"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each module holds one
operator; :mod:`tidemark.llm.queries` holds the thin registered queries.
"""
