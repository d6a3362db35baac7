"""Scalar functions over text, numbers and boxes."""
