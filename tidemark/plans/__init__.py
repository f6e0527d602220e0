"""Whole jobs built from the operators: extract, warehouse, load."""
