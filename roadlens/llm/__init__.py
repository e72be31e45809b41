"""Operators of a training-data pipeline over text and embedding tables.
Nothing else in the library imports this package; ``queries`` binds its
operators to the tables ``documents``, ``labels``, ``benchmark`` and
``embeddings``."""
