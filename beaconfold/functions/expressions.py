"""Expressions shared by the operators. All of them stay on the JVM.

Those used many times over in wide tables are SQL text: a few hundred of them go to the JVM
in one call each.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(text: str) -> str:
    """A string as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def first_where(value: str, condition: str, order: str) -> str:
    """Aggregate: the first non-null ``value`` in ``order`` among rows that meet ``condition``."""
    return f"min_by({value}, CASE WHEN {condition} AND {value} IS NOT NULL THEN {order} END)"


def flag_count(flag: str) -> str:
    """Aggregate: number of true flags, NULL (not 0) where every flag is NULL."""
    return f"sum(CAST({flag} AS INT))"


def local_hour(utchour: str, tz_offset: int) -> str:
    """Two-digit local hour of a UTC hour label; part-hour offsets are rounded down."""
    return f"lpad(CAST((CAST({utchour} AS INT) + {24 + tz_offset // 3600}) % 24 AS STRING), 2, '0')"


def base_name(key: Column) -> Column:
    """File name of an object key."""
    return F.regexp_extract(key, "[^/]*$", 0)


def nodash(data_date: str) -> str:
    """``2024-01-15`` to ``20240115``."""
    return data_date.replace("-", "")
