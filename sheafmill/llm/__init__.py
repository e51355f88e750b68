"""Operators that prepare text corpora for the training of language models.

Nothing outside this package imports it.
"""
