"""Operators for preparing text corpora for language-model training.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own interface; ``queries`` registers one query per operator.
"""
