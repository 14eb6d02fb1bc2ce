"""Operators of a large-scale training-data pipeline; nothing else in the library imports them."""
