"""Reading named parquet tables, and small inline row sets."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


class Tables(Mapping):
    """Tables of one folder by name; a table is opened when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str,
                 names: Sequence[str] = ("region", "nation", "customer", "supplier",
                                         "part", "orders", "lineitem")):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.names = tuple(names)
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)


def seed_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Inline typed rows.

    Built through Arrow so that Spark holds them as a local relation: their exact size is known to
    the optimizer, which then broadcasts them on its own when they are small.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrow_schema = to_arrow_schema(schema)
    arrays = [pa.array(list(values), type=field.type)
              for values, field in zip(columns, arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow_schema), schema=schema)


def series(spark: SparkSession, first: int, last: int) -> DataFrame:
    """The whole numbers first..last, both ends included, as column ``x``."""
    return spark.range(first, last + 1).withColumnRenamed("id", "x")
