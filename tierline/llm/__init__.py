"""Operators of a training-data pipeline over the tables ``documents`` and ``embeddings``.

Nothing else in the library imports this package; ``queries.py`` holds its registered queries and
their SQL, and ``corpus_pipeline.py`` (at the repository top) chains five of its operators.
"""
