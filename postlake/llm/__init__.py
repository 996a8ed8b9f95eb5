"""Operators for preparing training data from collected posts. Nothing else in the library imports them."""
