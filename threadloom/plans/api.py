"""Host calls over SQL: parameters are bound, never pasted; results come as values, rows or dictionaries."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession


class Database:
    """Named tables and the calls of an embedded database's binding, over spark.sql."""

    def __init__(self, spark: SparkSession, **tables: DataFrame) -> None:
        self.spark, self.tables = spark, tables

    def query(self, sql: str, bind: dict | list | None = None) -> DataFrame:
        """Tables are written as {name}; parameters as :name or ?."""
        return self.spark.sql(sql, args=bind, **self.tables) if bind else self.spark.sql(sql, **self.tables)

    def exec(self, sql: str, bind: dict | list | None = None, row_mode: str = "array") -> list:
        """All rows of the last statement; statements are separated by ';' at a line's end."""
        statements = [s for s in (part.strip().rstrip(";") for part in sql.split(";\n")) if s]
        out: list = []
        for s in statements:
            rows = self.query(s, bind).collect()
            out = [r.asDict(True) for r in rows] if row_mode == "object" else [list(r) for r in rows]
        return out

    def rows(self, sql: str, bind: dict | list | None = None) -> Iterator:
        """Rows one by one, a partition in memory at a time."""
        return self.query(sql, bind).toLocalIterator()

    def select_value(self, sql: str, bind: dict | list | None = None) -> Any:
        row = self.query(sql, bind).first()
        return row[0] if row is not None else None

    def select_values(self, sql: str, bind: dict | list | None = None) -> list:
        return [r[0] for r in self.query(sql, bind).collect()]

    def select_array(self, sql: str, bind: dict | list | None = None) -> list | None:
        row = self.query(sql, bind).first()
        return None if row is None else list(row)

    def select_object(self, sql: str, bind: dict | list | None = None) -> dict | None:
        row = self.query(sql, bind).first()
        return None if row is None else row.asDict(True)

    def select_arrays(self, sql: str, bind: dict | list | None = None) -> list[list]:
        return self.exec(sql, bind)

    def select_objects(self, sql: str, bind: dict | list | None = None) -> list[dict]:
        return self.exec(sql, bind, "object")

    def columns(self, table: str) -> list[tuple[str, str]]:
        return self.tables[table].dtypes

    def has(self, table: str) -> bool:
        return table in self.tables or self.spark.catalog.tableExists(table)
