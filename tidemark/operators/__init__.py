"""Batch and stream operators."""
