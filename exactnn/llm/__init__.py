"""Operators for language-model training data: quality, licences, secrets, tokens, duplicates.

Nothing outside this package imports it.
"""
