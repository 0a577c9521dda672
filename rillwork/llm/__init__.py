"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing outside this folder imports it. Each operator has a module of its own;
``queries`` registers the ten queries.
"""
