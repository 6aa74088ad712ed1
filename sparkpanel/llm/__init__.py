"""Operators for text corpora, vectors and web archives."""
