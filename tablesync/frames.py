"""Small literal frames."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_frame(spark: SparkSession, rows: Sequence[tuple[Any, ...]], schema: str | T.StructType) -> DataFrame:
    """Rows as a local relation: unlike a parallelized list, Catalyst knows it is small."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = [list(column) for column in zip(*rows)] if rows else [[] for _ in struct]
    table = pa.Table.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, to_arrow_schema(struct))],
        names=struct.names,
    )
    return spark.createDataFrame(table, struct)
