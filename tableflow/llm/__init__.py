"""Operators for the preparation of training text; nothing else in the library imports them.

Each module holds one operator. ``queries`` registers their ``opN_`` queries and the pipeline.
"""
