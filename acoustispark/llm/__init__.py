"""Operators of a training-data pipeline over documents, pages, benchmark, labels and embeddings."""

from acoustispark.llm.queries import registry

__all__ = ["registry"]
