"""Read-only scans of a crawler's SQLite file as a Spark data source (``glossmill_sqlite``).

The file is opened immutable and is never created. Tables are split by rowid ranges, so a scan has as many
tasks as asked for; columns are probed, so that older stores without late columns are read as they are. Only the columns
asked for are read (such a source isn't told which a plan needs, so the caller names them), and comparisons of a column
with a value, of nulls and of lists of values are made by the store.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual
from pyspark.sql.types import LongType, StringType, StructField, StructType

KINDS = {"INTEGER": LongType()}


def _open(path: str):
    import sqlite3

    p = Path(path).resolve()
    if not p.is_file():
        raise FileNotFoundError(f"no such store: {path}")
    return sqlite3.connect(f"{p.as_uri()}?mode=ro&immutable=1", uri=True)


class Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


_SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


class SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names, self.path, self.name, self.parts = schema.fieldNames(), options["path"], options["dbtable"], int(options.get("partitions", "8"))
        self.kinds = {f.name: f.dataType for f in schema}
        self.tests: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes the filters that the store can make exactly; numbers only for numbers, since a store may hold any kind of value."""
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            kind = int if isinstance(self.kinds.get(name), LongType) else None
            if isinstance(f, (IsNull, IsNotNull)) and name in self.kinds:
                self.tests.append((f'"{name}" IS {"NOT " if isinstance(f, IsNotNull) else ""}NULL', []))
            elif type(f) in _SIGNS and kind is not None and isinstance(f.value, kind):
                self.tests.append((f'"{name}" {_SIGNS[type(f)]} ?', [f.value]))
            elif isinstance(f, EqualTo) and name in self.kinds and kind is None and isinstance(f.value, str):
                self.tests.append((f'"{name}" = ? COLLATE BINARY', [f.value]))
            elif isinstance(f, In) and kind is not None and len(f.value) <= 500 and all(isinstance(v, kind) for v in f.value):
                self.tests.append((f'"{name}" IN ({", ".join("?" * len(f.value))})', list(f.value)))
            else:
                yield f

    def partitions(self) -> list[Range]:
        conn = _open(self.path)
        try:
            low, high = conn.execute(f'SELECT min(rowid), max(rowid) FROM "{self.name}"').fetchone()
        finally:
            conn.close()
        if low is None:
            return [Range(0, -1)]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [Range(a, min(high, a + step - 1)) for a in range(low, high + 1, step)]

    def read(self, partition: Range) -> Iterator[tuple]:
        conn = _open(self.path)
        try:
            columns = ", ".join(f'"{c}"' for c in self.names)
            where = "".join(f" AND {test}" for test, _ in self.tests)
            values = [v for _, given in self.tests for v in given]
            yield from conn.execute(f'SELECT {columns} FROM "{self.name}" WHERE rowid BETWEEN ? AND ?{where}', (partition.low, partition.high, *values))
        finally:
            conn.close()


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "glossmill_sqlite"

    def schema(self) -> StructType:
        conn = _open(self.options["path"])
        try:
            rows = conn.execute(f'PRAGMA table_info("{self.options["dbtable"]}")').fetchall()
        finally:
            conn.close()
        wanted = self.options.get("columns")
        names = None if wanted is None else {c.lower() for c in json.loads(wanted)}
        return StructType([StructField(r[1], KINDS.get((r[2] or "").upper(), StringType())) for r in rows if names is None or r[1].lower() in names])

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(schema, dict(self.options))


def read_sqlite(spark: SparkSession, path: str, name: str, partitions: int = 8, columns: list[str] | None = None) -> DataFrame:
    """A table of a store, or those of ``columns`` that it has; a missing table gives ValueError, a missing file FileNotFoundError."""
    conn = _open(path)
    try:
        if conn.execute("SELECT 1 FROM sqlite_master WHERE type = 'table' AND name = ?", (name,)).fetchone() is None:
            raise ValueError(f"no table {name!r} in {path}")
    finally:
        conn.close()
    spark.dataSource.register(SqliteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("glossmill_sqlite").option("path", path).option("dbtable", name).option("partitions", str(partitions))
    return (reader if columns is None else reader.option("columns", json.dumps(columns))).load()
