"""Operators for preparing language-model training data.

``catalog`` registers one query per operator; nothing outside this package imports it.
"""
