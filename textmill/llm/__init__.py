"""Operators of a training-data pipeline: language ID, toxicity, quality,
licences, near-duplicates, token counts, source mixing and packing.

Nothing else in the library imports this subpackage.
"""
