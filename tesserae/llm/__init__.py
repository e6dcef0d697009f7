"""Operators for cleaning and shaping language-model training text. Nothing outside this package imports it."""
