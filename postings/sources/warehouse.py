"""A listing warehouse as a Spark data source: filters, columns, order and limit reach the reader.

Tables are Parquet files whose row groups are the partitions. A pushed filter first leaves out row
groups whose statistics rule it out, then rows while they are read. With ``limit`` every
partition hands over its own first rows in order only, and Spark puts these together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as fs
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringStartsWith
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "listing_warehouse"


@dataclass
class RowGroups(InputPartition):
    path: str
    groups: list[int]


def _files(options: dict) -> ds.Dataset:
    system, path = _system(options)
    return ds.dataset(path, filesystem=system, format="parquet", exclude_invalid_files=False)


def _system(options: dict) -> tuple[fs.FileSystem, str]:
    path = options["path"]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def expression(f: Filter) -> pc.Expression | None:
    """The reader's form of a pushed filter, or None where it has none. Comparisons with null match nothing, as in Spark."""
    if isinstance(f, Not):
        inner = expression(f.child)
        return None if inner is None else ~inner
    if len(getattr(f, "attribute", ())) != 1:
        return None
    column = ds.field(f.attribute[0])
    if isinstance(f, IsNotNull):
        return column.is_valid()
    if isinstance(f, IsNull):
        return column.is_null()
    if isinstance(f, In):
        return column.isin(pa.array([v for v in f.value if v is not None])) if any(v is not None for v in f.value) else None
    if isinstance(f, StringStartsWith):
        return pc.starts_with(column, f.value)
    value = f.value
    if isinstance(value, float) and value != value:
        return None  # Spark holds NaN equal to itself and above all numbers
    if isinstance(f, EqualNullSafe):
        return column.is_null() if value is None else column.is_valid() & (column == value)
    forms = {EqualTo: lambda: column == value, GreaterThan: lambda: column > value, GreaterThanOrEqual: lambda: column >= value, LessThan: lambda: column < value, LessThanOrEqual: lambda: column <= value}
    return forms[type(f)]() if type(f) in forms and value is not None else None


class WarehouseReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.options, self.where = schema, options, None
        self.limit = int(options["limit"]) if "limit" in options else None
        self.order = [(c.strip().removesuffix(" desc"), "descending" if c.strip().endswith(" desc") else "ascending") for c in options.get("order", "").split(",") if c.strip()]
        if self.limit is not None and not self.order:
            raise ValueError("a limit needs an order")
        for name in ("source", "status"):
            if name in options:
                self._and(ds.field(options[f"{name}_column"]) == options[name])
        if "since" in options:
            self._and(ds.field(options["since_column"]) >= datetime.fromisoformat(options["since"]))

    def _and(self, e: pc.Expression) -> None:
        self.where = e if self.where is None else self.where & e

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes what it can say; with a limit nothing, since a filter above a limit can't go below it."""
        floats = {f.name for f in self.schema.fields if f.dataType.typeName() in ("float", "double")}
        for f in filters:
            inner = f.child if isinstance(f, Not) else f
            e = None if self.limit is not None or set(getattr(inner, "attribute", ())) & floats and not isinstance(inner, IsNull | IsNotNull) else expression(f)
            if e is None:
                yield f
            else:
                self._and(e)

    def partitions(self) -> list[RowGroups]:
        """A partition a row group that the filter may match, by the file's statistics."""
        out = []
        for fragment in _files(self.options).get_fragments(self.where):
            out += [RowGroups(fragment.path, [g.id for g in part.row_groups]) for part in fragment.split_by_row_group(self.where)]
        return out

    def read(self, partition: RowGroups) -> Iterator[pa.RecordBatch]:
        fragment = ds.ParquetFileFormat().make_fragment(partition.path, filesystem=_system(self.options)[0], row_groups=partition.groups)
        names = [f.name for f in self.schema.fields]
        kept = None
        for batch in fragment.to_batches(columns=names, filter=self.where):
            if self.limit is None:
                yield batch
                continue
            rows = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            kept = rows.take(pc.sort_indices(rows, sort_keys=self.order, null_placement="at_end")[: self.limit]) if rows.num_rows > self.limit else rows
        if kept is not None:
            yield from kept.to_batches()


class Warehouse(DataSource):
    """Options: ``path``; ``order`` ("a desc, b") and ``limit``; ``source``, ``status``, ``since`` with the names of their columns."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return from_arrow_schema(_files(self.options).schema, prefer_timestamp_ntz=True)

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarehouseReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Warehouse)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def scan(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Rows of a table, whose filters go to the reader.

    Spark doesn't tell a Python source which columns a query uses: name those to read, the filters' among them.
    """
    return _columns(_reader(spark, path), columns).load()


def _reader(spark: SparkSession, path: str) -> DataFrameReader:
    register(spark)
    return spark.read.format(FORMAT).option("path", path)


def _columns(reader: DataFrameReader, columns: list[str] | None) -> DataFrameReader:
    if columns is None:
        return reader
    known = reader.load().schema
    return reader.schema(StructType([known[c] for c in columns]))


def listings(
    spark: SparkSession, path: str, order: list[str], *, columns: list[str] | None = None, source: tuple[str, str] | None = None, status: tuple[str, str] | None = None,
    since: tuple[str, datetime] | None = None, limit: int | None = None,
) -> DataFrame:
    """Rows with ``source`` and ``status`` (column, value), at or after ``since`` (column, time), first ``limit`` by ``order`` ("a desc", nulls last).

    A missing condition holds for all rows. With a limit the conditions are options of the reader, so
    that they come before it; else they are filters that Spark pushes. ``columns`` holds the order's columns.
    """
    reader = _columns(_reader(spark, path), columns)
    keys = [F.desc_nulls_last(c.removesuffix(" desc")) if c.endswith(" desc") else F.asc_nulls_last(c) for c in order]
    if limit is None:
        df = reader.load()
        for pair in (source, status):
            df = df.where(F.col(pair[0]) == pair[1]) if pair else df
        df = df.where(F.col(since[0]) >= F.lit(since[1]).cast(df.schema[since[0]].dataType)) if since else df
        return df.orderBy(*keys)
    reader = reader.option("order", ", ".join(order)).option("limit", limit)
    for name, pair in (("source", source), ("status", status), ("since", since)):
        if pair:
            reader = reader.option(f"{name}_column", pair[0]).option(name, pair[1].isoformat() if name == "since" else pair[1])
    return reader.load().orderBy(*keys).limit(limit)
