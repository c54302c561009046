"""Operators for preparing language-model training corpora.

Each module holds one operator with a general interface; ``queries`` registers
one thin query per operator.  Nothing outside this subpackage imports it.
"""
