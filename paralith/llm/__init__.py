"""Operators of a training-data pipeline: cleaning, deduplication, scanning and encoding of text corpora.

Every operator takes and returns DataFrames.  Nothing outside this subpackage imports it.
"""
