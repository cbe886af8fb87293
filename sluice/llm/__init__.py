"""Operators for large-scale training-data work on documents, embeddings and urls."""
