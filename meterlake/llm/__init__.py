"""Operators of a training-data pipeline over the ``documents`` and ``pages`` tables.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when the folder is present.
"""
