"""Operators for training corpora: filters, deduplication, mixing and token output.

Nothing else in the package imports this subpackage.
"""
