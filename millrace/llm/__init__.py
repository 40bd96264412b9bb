"""Operators for preparing text corpora: scans, deduplication, scoring, token work and sharding.

Nothing else in the library imports this subpackage. Operators take and return DataFrames. They read only the columns
they name, so further columns of the input, whatever their names, neither reach nor disturb them.
"""
