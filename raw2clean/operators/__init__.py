"""Whole-table operators: shape, dedup, quality."""
