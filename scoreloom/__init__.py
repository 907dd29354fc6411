"""Build machine-learning datasets from symbolic music with Spark DataFrames."""

from scoreloom.model import SeqSet

__all__ = ["SeqSet"]
