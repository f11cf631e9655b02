"""Whole-job plans built from the operators."""
