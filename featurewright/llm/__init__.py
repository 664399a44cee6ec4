"""Operators for training-data pipelines: dedup, packing, mixing, language id, secrets, search.

Nothing else in the library imports this subpackage.  Every operator reads
only the columns it is told to (``id_col``, ``text_col``, ...) and returns its
own columns, so extra input columns with clashing names do not matter.
"""
