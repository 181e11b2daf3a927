"""lodgeframe: rental-market analytics as plain Spark DataFrame operators.

Every public operator takes DataFrames (and parameters) and returns a
DataFrame; nothing is collected to the driver except model fitting, which
is Spark MLlib's own distributed work.

Sub-packages
------------
functions  Column -> Column expressions (parsing, geo maths, text helpers)
sources    readers / writers and the domain fixtures derived from test tables
operators  joins, aggregates and pipelines built from those expressions
plans      the named query registry (Spark side and DuckDB oracle side)
streaming  Structured Streaming wrappers around the batch operators
"""

from lodgeframe.session import get_session  # noqa: F401

__all__ = ["get_session"]
