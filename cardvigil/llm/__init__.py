"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing else in the library imports this package; the registered queries are in
``queries.py`` and their SQL in ``oracles.py``.
"""
