"""Operators for building training data from text, vectors and web pages."""
