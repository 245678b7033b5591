"""Operators for large training-data pipelines (text, embeddings, chats).

Nothing else in the library imports this subpackage.  Each module holds one
operator with its general interface; ``queries.py`` derives the registered
``opN_<name>`` results from them.
"""
