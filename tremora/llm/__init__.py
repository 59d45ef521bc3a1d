"""Operators for preparing language-model training text, over tables of documents.

A table of documents has ``doc_id`` (integer) and ``text``; other columns are ignored
or passed through, whatever their names. Unless an operator says otherwise, a null
text counts as empty, an empty table gives an empty result, rows that repeat one
``doc_id`` are treated one by one, and whole texts are read, however long.
"""
