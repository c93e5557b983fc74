"""Operators: block matrix addition, min-label propagation, rating histogram."""
