"""Scalar functions: text, terms, arrays, maps, numbers, dates and hashes; all are Columns of built-in functions."""
