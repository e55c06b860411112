"""Operators and pipeline stages for preparing language-model training data."""
