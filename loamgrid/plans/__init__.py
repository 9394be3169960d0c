"""Whole products built from the operators."""
