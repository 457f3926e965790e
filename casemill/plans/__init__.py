"""Whole cohorts, composed from the operators."""
