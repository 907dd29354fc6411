"""Sequence operators. Importing the package registers all of them."""

from scoreloom.operators import attributes, augment, melody, quantize, represent, slicing, split, transform

__all__ = ["attributes", "augment", "melody", "quantize", "represent", "slicing", "split", "transform"]
