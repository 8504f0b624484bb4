"""Operators for preparing training text and vectors at scale.

Each module holds one operator and its general interface; ``queries`` registers
one query per operator.  Nothing outside this package imports it.
"""
