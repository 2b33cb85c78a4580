"""Operators for preparing training data: mixing, chat formatting,
near-duplicate detection, personal data, token counts, web archives,
language identification, vector search, quality rules and byte-pair
encoding. Nothing else in the library imports this subpackage.

``strata.llm.queries`` holds the thin registered queries,
``strata.llm.oracle`` their SQL where SQL can express them.
"""
