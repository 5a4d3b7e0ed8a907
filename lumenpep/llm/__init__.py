"""Operators for preparing training data, each a Spark job of its own.

Nothing outside this subpackage imports it.
"""
