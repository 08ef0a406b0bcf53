"""Whole jobs built from the operators: staging loads, mart refresh, reports."""
