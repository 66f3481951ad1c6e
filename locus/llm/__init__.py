"""Operators of a training-data pipeline over documents and embeddings.

One module per operator, each with a general interface of its own; the
registered queries are in ``queries.py`` and their SQL in ``oracles.py``.
Nothing outside this subpackage imports it.
"""
