"""Operators for preparing training data: texts, pages, vectors and conversations."""
