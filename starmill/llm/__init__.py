"""Operators for training-data corpora.

Nothing else in the library imports this subpackage; ``queries.py`` registers
its queries. Every operator names the columns it reads and returns a frame of
its own columns, so further columns of the input, whatever their names, never
clash with what it adds.
"""
