"""Operators of a training-data pipeline over ``documents``, ``embeddings`` and ``pages``.

Nothing else in the package imports this subpackage. Every operator is a
function from DataFrames to a DataFrame; ``queries.py`` holds the thin
registered queries ``op1_`` ... ``op10_``.
"""
