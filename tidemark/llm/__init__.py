"""Operators that prepare text corpora for language-model training.

Nothing outside this package imports it.  Each module holds one operator; ``queries``
registers one query per operator over the given tables.
"""
