"""Lazy sources: each group is read row by row until it has enough, and where it broke off is on record."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vecloom.sources.staging import stage

# opens a group and yields its rows, as tuples in the order of the schema; it may raise at any row
Open = Callable[[str], Iterable[tuple]]


@dataclass
class Wanted(InputPartition):
    """One group, and how many of its rows are wanted."""

    group: str
    limit: int


class LazyReader(DataSourceReader):
    def __init__(self, open_group: Open, width: int, limits: Mapping[str, int]):
        self.open_group, self.width, self.limits = open_group, width, limits

    def partitions(self) -> list[InputPartition]:
        return [Wanted(group, limit) for group, limit in self.limits.items()]

    def read(self, partition: Wanted) -> Iterator[tuple]:
        """Rows (group, place, error, ...) up to the limit; the source is not asked for more.

        If the source raises, the last row holds what it said, and at its place no values.
        """
        place = 0
        try:
            if partition.limit <= 0:
                return
            for values in self.open_group(partition.group):
                yield (partition.group, place, None, *values)
                place += 1
                if place >= partition.limit:
                    return
        except Exception as error:  # whatever a source of rows may raise
            yield (partition.group, place, f"{type(error).__name__}: {error}", *[None] * self.width)


def lazy_format(name: str, schema: str, width: int, open_group: Open) -> type[DataSource]:
    """A data source of that name; its option `limits` is a JSON object of groups and row limits."""

    class Lazy(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return f"lang string, place long, error string, {schema}"

        def reader(self, schema) -> DataSourceReader:
            return LazyReader(open_group, width, json.loads(self.options["limits"]))

    return Lazy


def read_groups(
    spark: SparkSession, name: str, schema: Mapping[str, str], open_group: Open, limits: Mapping[str, int]
) -> tuple[DataFrame, DataFrame]:
    """Rows (lang, place, columns of the schema) of each group up to its limit, and the record (lang, n_read, error).

    Groups are read side by side, a partition each, and a partition stops at its limit. The record has a row for
    each group that broke off, with the number of rows read before. Both come from one written table, so that what was
    read and what is on record agree, and no source is asked twice.
    """
    columns = ", ".join(f"`{c}` {kind}" for c, kind in schema.items())
    spark.dataSource.register(lazy_format(name, columns, len(schema), open_group))
    read = stage(spark.read.format(name).option("limits", json.dumps(dict(limits))).load(), name)
    rows = read.where("error IS NULL").select("lang", "place", *schema)
    return rows, read.where("error IS NOT NULL").select("lang", F.col("place").alias("n_read"), "error")


def parquet_groups(path: str, columns: Iterable[str], by: str) -> Open:
    """Opens a group of a Parquet table: its rows in file order, a batch at a time, with the filter in the scan."""
    names = list(columns)

    def open_group(group: str) -> Iterator[tuple]:
        import pyarrow.dataset as ds

        table = ds.dataset(path, format="parquet")
        for batch in table.to_batches(columns=names, filter=ds.field(by) == group, batch_size=1_000, batch_readahead=1, fragment_readahead=1):
            yield from zip(*(c.to_pylist() for c in batch.columns))

    return open_group


def breaking_off(open_group: Open, after: Mapping[str, int]) -> Open:
    """A source of which some groups fail once they gave so many rows, or all they have; for tests and drills."""

    def failing(group: str) -> Iterator[tuple]:
        place = 0
        for values in open_group(group):
            if place >= after.get(group, place + 1):
                break
            yield values
            place += 1
        if group in after:
            raise ConnectionError(f"{group} broke off after {place} rows")

    return failing
