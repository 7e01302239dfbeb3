"""Tables of a database, read through Spark's JDBC source."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import ROWVER
from tablesync.sources.frames import TableSource
from tablesync.spec import Connection

# Driver class of each dialect.
DRIVERS = {
    "mssql": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "oracle": "oracle.jdbc.OracleDriver",
    "postgresql": "org.postgresql.Driver",
}


def jdbc_url(dialect: str, host: str, port: int, database: str) -> str:
    if dialect == "mssql":
        return f"jdbc:sqlserver://{host}:{port};databaseName={database}"
    if dialect == "oracle":
        return f"jdbc:oracle:thin:@//{host}:{port}/{database}"
    if dialect == "postgresql":
        return f"jdbc:postgresql://{host}:{port}/{database}"
    raise ValueError(f"Unsupported dialect: {dialect}")


def jdbc_options(connection: Connection, fetch_size: int = 10_000) -> dict[str, str]:
    return {
        "url": jdbc_url(connection.dialect, connection.host, connection.port, connection.database),
        "driver": DRIVERS[connection.dialect],
        "user": connection.username,
        "password": connection.password,
        "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true",
    }


def read_jdbc(spark: SparkSession, options: Mapping[str, str], **more: str) -> DataFrame:
    return spark.read.format("jdbc").options(**{**options, **more}).load()


def read_jdbc_split(
    spark: SparkSession, options: Mapping[str, str], predicates: list[str], **more: str
) -> DataFrame:
    """One partition, and one connection, per predicate."""
    properties = {**options, **more}
    return spark.read.jdbc(properties.pop("url"), properties.pop("dbtable"), predicates=predicates, properties=properties)


def literal(dialect: str, value: Any) -> str | None:
    """A value as the source writes it; None if it has no ordered literal."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, dt.date):
        return timestamp_literal(dialect, value)
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else None


def split_predicates(dialect: str, column: str, tops: list[Any]) -> list[str]:
    """Conditions that split a relation at the greatest values of its shares: every row meets exactly one.

    Shares that end at one value are one. NULLs go with the first, and rows that come meanwhile with a greater value with the last.
    """
    known = sorted({top for top in tops if top is not None})
    written = [literal(dialect, top) for top in known[:-1]]
    if not written or None in written:
        return []
    first = f"({column} <= {written[0]} OR {column} IS NULL)"
    middle = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(written[:-1], written[1:], strict=True)]
    return [first, *middle, f"{column} > {written[-1]}"]


def rowversion_above(rowver_col: str, low: int) -> str:
    """A condition the source can answer from an index on the row version."""
    return f"{rowver_col} > CONVERT(BINARY(8), CAST({int(low)} AS BIGINT))"


def rowversion_relation(table: str, rowver_col: str, low: int | None = None, high: int | None = None) -> str:
    """A relation that adds ``__rowver``, converted and filtered by the source."""
    number = f"CONVERT(BIGINT, {rowver_col})"
    tests = []
    if low is not None:
        tests.append(f"{number} > {int(low)}")
        if low >= 0:
            tests.append(rowversion_above(rowver_col, low))
    if high is not None:
        within = f"{number} <= {int(high)}"
        tests.append(within if low is not None else f"({within} OR {rowver_col} IS NULL)")
    where = f" WHERE {' AND '.join(tests)}" if tests else ""
    return f"(SELECT t.*, {number} AS {ROWVER} FROM {table} t{where}) q"


def moment(value: dt.date | None) -> dt.datetime | None:
    """A watermark as a wall-clock time; a DATE is its midnight."""
    if value is None or isinstance(value, dt.datetime):
        return value.replace(tzinfo=None) if value is not None else None
    return dt.datetime(value.year, value.month, value.day)


def timestamp_literal(dialect: str, value: dt.date) -> str:
    text = moment(value).isoformat(sep=" ")
    return f"CAST('{text}' AS datetime2)" if dialect == "mssql" else f"TIMESTAMP '{text}'"


def timestamp_relation(
    dialect: str, table: str, watermark_col: str, low: dt.date | None, high: dt.date | None
) -> str:
    """A relation of the rows with ``low < watermark <= high``, filtered by the source itself.

    Spark's dialects do not all write a local date-time as a literal. A column may hold finer digits than the
    microseconds of ``high``, so the bound is the next microsecond, left out.
    """
    tests = []
    if low is not None:
        tests.append(f"{watermark_col} > {timestamp_literal(dialect, low)}")
    if high is not None:
        end = moment(high) + dt.timedelta(microseconds=1)
        within = f"{watermark_col} < {timestamp_literal(dialect, end)}"
        tests.append(within if low is not None else f"({within} OR {watermark_col} IS NULL)")
    return f"(SELECT * FROM {table} WHERE {' AND '.join(tests)}) q" if tests else table


def oracle_columns(df: DataFrame) -> DataFrame:
    """Oracle's rows as the target knows them: lower-case names, and whole numbers as bigint.

    Oracle has one number type; what is declared without decimals is an integer. A bare ``NUMBER``
    leaves that open: name its type in the source's ``custom_schema``.
    """

    def column(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision <= 18:
            value = value.cast("bigint")
        return value.alias(field.name.lower() if field.name.isupper() else field.name)

    return df.select(*[column(f) for f in df.schema])


@dataclass
class JdbcSource(TableSource):
    """One database table.

    ``partition_column`` splits the read into up to ``num_partitions`` ranges with about as many rows each, whatever the
    column's type and skew: the source itself finds where they end. A single value is never split, so a key
    without hot values is best. Without it one connection streams the rows. ``custom_schema`` names
    the types of columns where the database's own are too wide, e.g. ``"ID BIGINT"``.
    """

    session: SparkSession
    options: dict[str, str] = field(repr=False)
    table: str
    dialect: str = "oracle"
    partition_column: str | None = None
    num_partitions: int = 1
    custom_schema: str | None = None

    @property
    def spark(self) -> SparkSession:
        return self.session

    @property
    def frame(self) -> DataFrame:
        return self._read(self.table)

    def query(self, text: str) -> DataFrame:
        """Run a query at the source."""
        return read_jdbc(self.session, self.options, query=text)

    def bounds_query(self, relation: str) -> str:
        """The greatest value of each of as many equal shares of the rows that are read, not of the whole table: a
        delta has mostly new keys."""
        column = self.partition_column
        tiles = f"SELECT {column} AS v, NTILE({self.num_partitions}) OVER (ORDER BY {column}) AS tile FROM {relation} WHERE {column} IS NOT NULL"
        return f"SELECT MAX(v) AS hi FROM ({tiles}) q GROUP BY tile"

    def _read(self, relation: str) -> DataFrame:
        more = {"dbtable": relation}
        if self.custom_schema:
            more["customSchema"] = self.custom_schema
        predicates: list[str] = []
        if self.partition_column and self.num_partitions > 1:
            found = self.query(self.bounds_query(relation)).collect()  # a row per range
            predicates = split_predicates(self.dialect, self.partition_column, [r[0] for r in found])
        if predicates:
            rows = read_jdbc_split(self.session, self.options, predicates, **more)
        else:
            rows = read_jdbc(self.session, self.options, **more)
        return oracle_columns(rows) if self.dialect == "oracle" else rows

    def window(
        self, watermark_col: str, low: dt.datetime | None = None
    ) -> tuple[dt.datetime | None, int | None]:
        """The source computes both itself; the plain JDBC relation would send every row."""
        top = moment(self.query(f"SELECT MAX({watermark_col}) AS high FROM {self.table}").first()[0])
        if low is None:
            return top, None
        above = f"{watermark_col} > {timestamp_literal(self.dialect, low)}"
        return top, int(self.query(f"SELECT COUNT(*) AS n FROM {self.table} WHERE {above}").first()[0])

    def high(self, watermark_col: str, low: dt.datetime | None = None) -> dt.datetime | None:
        return moment(self.query(f"SELECT MAX({watermark_col}) AS high FROM {self.table}").first()[0])

    def by_timestamp(
        self, watermark_col: str, low: dt.datetime | None = None, high: dt.datetime | None = None
    ) -> DataFrame:
        return self._read(timestamp_relation(self.dialect, self.table, watermark_col, low, high))

    def by_rowversion(self, rowver_col: str, low: int | None = None, high: int | None = None) -> DataFrame:
        if self.dialect != "mssql":
            return super().by_rowversion(rowver_col, low, high)
        return self._read(rowversion_relation(self.table, rowver_col, low, high))

    def high_rowversion(self, rowver_col: str, low: int | None = None) -> int | None:
        if self.dialect != "mssql":
            return super().high_rowversion(rowver_col, low)
        relation = rowversion_relation(self.table, rowver_col, low)
        top = self.query(f"SELECT MAX({ROWVER}) AS high FROM {relation}").first()[0]
        return None if top is None else int(top)


@dataclass(frozen=True)
class JdbcLocation:
    """A database, as a place to read from or to sync into."""

    connection: Connection
    watermark_path: str | None = None
    partition_columns: Mapping[str, str] = field(default_factory=dict)
    custom_schemas: Mapping[str, str] = field(default_factory=dict)
    num_partitions: int = 4

    def source(self, spark: SparkSession, table: str) -> JdbcSource:
        column = self.partition_columns.get(table)
        return JdbcSource(
            spark,
            jdbc_options(self.connection),
            table,
            self.connection.dialect,
            column,
            self.num_partitions if column else 1,
            self.custom_schemas.get(table),
        )

    def target(self, spark: SparkSession, schema: str, table: str, keys: tuple[str, ...]):
        from tablesync.sinks.jdbc_table import JdbcTable

        return JdbcTable.open(
            spark,
            jdbc_options(self.connection),
            schema,
            table,
            keys,
            self.watermark_path,
            self.num_partitions,
        )
