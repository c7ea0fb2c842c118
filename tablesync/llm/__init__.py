"""Operators for preparing large text corpora; nothing else in the library imports them.

Conventions of all operators: ``row`` in a result is the whole input row as a
struct, so extra columns pass through and no name can clash. A row without an id
takes part in no comparison and stays as it is; rows that share an id count as
one document. A missing text is an empty one.
"""
