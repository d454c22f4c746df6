"""Operators for preparing training text at scale.

One module per operator; ``queries`` registers one query per operator and
``corpus_pipeline`` (repository top) chains five of them.  Nothing outside
this subpackage imports it.
"""
