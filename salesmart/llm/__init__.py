"""Operators for preparing training data for language models.

Thirteen operators, each in a module of its own, and the queries that apply them
to whole tables (``queries.py``). Nothing else in the library imports this
subpackage.
"""
