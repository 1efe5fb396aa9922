"""Operators for large text corpora (training-data preparation).

One module per operator.  Nothing outside this subpackage imports it; the
registered queries are in :mod:`keyfold.llm.queries`.
"""
