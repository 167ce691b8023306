"""Names for helper columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(name: str, *tables: DataFrame) -> str:
    """``name``, made longer until no column of ``tables`` has it, whatever the case."""
    taken = {column.lower() for table in tables for column in table.columns}
    while name.lower() in taken:
        name += "_"
    return name
