"""Incident-record analytics as PySpark DataFrame operators.

Every operator has the shape ``op(df, *, options...) -> DataFrame`` so that calls chain with
``DataFrame.transform``.  Operators are lazy; the few that must run a job say so.
"""

from blotterlake.config import Settings

__all__ = ["Settings"]
