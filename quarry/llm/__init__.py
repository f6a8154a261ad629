"""Operators of a training-data pipeline over a table `documents`.

One module per operator, `queries.py` with the registered queries. Nothing
outside this subpackage imports it; `__spark_entry__.py` adds its queries when
it is there.
"""
