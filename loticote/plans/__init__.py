"""Whole batches built from the operators."""
