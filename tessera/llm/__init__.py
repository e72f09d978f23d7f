"""Operators that prepare text and code collections for model training."""
