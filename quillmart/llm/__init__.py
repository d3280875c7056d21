"""Operators for preparing training text at scale.

Thirteen operators and the queries that apply them; nothing else in the library
imports this subpackage.
"""
