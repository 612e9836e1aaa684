"""Operators for preparing large text corpora.

Each module holds one operator with a general interface (real texts, spans,
files, neighbour lists); ``queries`` binds them to the driver's tables.
"""
