"""Spark-native grading and clean-up of text and code corpora."""

from corpusq.config import Settings

__all__ = ["Settings"]
__version__ = "0.1.0"
