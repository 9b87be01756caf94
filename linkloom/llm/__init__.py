"""Operators that prepare training text for language models.

Nothing else in the package imports this subpackage.  Every operator takes and
returns DataFrames; the ``opN_*`` queries in :mod:`linkloom.llm.queries` apply
them to whole tables.
"""
