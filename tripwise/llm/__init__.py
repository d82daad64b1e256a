"""Operators of a training-data pipeline, one module each.

Nothing outside this subpackage imports it.  ``queries.py`` registers one query
per operator; ``common.py`` has the few helpers the operators share.
"""
