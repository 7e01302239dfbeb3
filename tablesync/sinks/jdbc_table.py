"""A keyed target table in PostgreSQL: distributed write to a staging table, then one merge there."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession

from tablesync import files
from tablesync.sinks.report import LoadSummary, Mark, run_batches
from tablesync.sinks.staging import StagedDelta, stage_delta
from tablesync.sinks.watermark import WatermarkStore
from tablesync.sources.catalog import read_catalog
from tablesync.sources.jdbc import read_jdbc
from tablesync.spec import ColumnSpec, SyncConfig, TargetSpec


def merge_sql(spec: TargetSpec, staging: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """Insert new keys and overwrite the other given columns of existing ones.

    The staging table holds Spark's types, so each column is cast to the declared one.
    """

    def names(listed: Sequence[str]) -> str:
        return ", ".join(f'"{c}"' for c in listed)

    values = ", ".join(f'CAST("{c}" AS {spec.column(c).data_type})' for c in columns)
    update = ", ".join(f'"{c}" = EXCLUDED."{c}"' for c in columns if c not in keys)
    action = f"DO UPDATE SET {update}" if update else "DO NOTHING"
    return (
        f"INSERT INTO {spec.schema}.{spec.table} ({names(columns)}) SELECT {values} FROM {staging} "
        f"ON CONFLICT ({names(keys)}) {action}"
    )


# Fixed value: the table of watermarks that users of a target database query.
WATERMARKS = "etl_watermarks"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def watermarks_sql(schema: str) -> str:
    return (
        f"CREATE TABLE IF NOT EXISTS {schema}.{WATERMARKS} (table_name text PRIMARY KEY, "
        "last_value timestamp with time zone, last_rowver bigint, updated_at timestamp with time zone DEFAULT now())"
    )


def mark_sql(schema: str, source: str, mark: Mark) -> str:
    """Set the slots the mark holds; an empty one keeps its value."""
    moment = f"TIMESTAMP WITH TIME ZONE '{mark.last_value.isoformat(sep=' ')}+00'" if mark.last_value else "NULL"
    version = "NULL" if mark.last_rowver is None else str(int(mark.last_rowver))
    slots = ", ".join(f"{c} = COALESCE(EXCLUDED.{c}, {WATERMARKS}.{c})" for c in ("last_value", "last_rowver"))
    return (
        f"INSERT INTO {schema}.{WATERMARKS} (table_name, last_value, last_rowver, updated_at) "
        f"VALUES ({_quoted(source)}, {moment}, {version}, now()) "
        f"ON CONFLICT (table_name) DO UPDATE SET {slots}, updated_at = EXCLUDED.updated_at"
    )


def create_sql(spec: TargetSpec, keys: Sequence[str], recreate: bool = False) -> list[str]:
    """Statements that make the target table: if it is missing, or anew."""

    def column(c: ColumnSpec) -> str:
        needed = " NOT NULL" if not c.nullable or c.name in keys else ""
        default = f" DEFAULT {c.default}" if c.default is not None else ""
        return f'"{c.name}" {c.data_type}{needed}{default}'

    name = f"{spec.schema}.{spec.table}"
    primary = ", ".join(f'"{k}"' for k in keys)
    listed = ", ".join([*map(column, spec.columns), f"PRIMARY KEY ({primary})"])
    drop = [f"DROP TABLE IF EXISTS {name} CASCADE"] if recreate else []
    return [*drop, f"CREATE TABLE IF NOT EXISTS {name} ({listed})"]


def run_transaction(connection: Any, statements: Sequence[str]) -> None:
    """All statements or none, on a JDBC connection."""
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            handle = connection.createStatement()
            handle.execute(statement)
            handle.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


class JdbcTable:
    """The executors write the delta into a staging table over several connections; one statement in
    one transaction moves it into the target. Rows never pass through the driver.

    Watermarks lie in the target's schema and move in the transaction of the last batch, unless a store
    elsewhere is given."""

    def __init__(
        self,
        spark: SparkSession,
        options: dict[str, str],
        spec: TargetSpec,
        keys: Sequence[str],
        store: WatermarkStore | None = None,
        connections: int = 4,
        connect: Callable[[], Any] | None = None,
    ) -> None:
        self.spark = spark
        self.options = options
        self.spec = spec
        self.keys = tuple(keys)
        self.store = store
        self.connections = connections
        self._connect = connect or self._driver_connection

    @classmethod
    def open(
        cls,
        spark: SparkSession,
        options: dict[str, str],
        schema: str,
        table: str,
        keys: Sequence[str],
        watermark_path: str | None,
        connections: int,
    ) -> JdbcTable | None:
        spec = read_catalog(lambda q: read_jdbc(spark, options, query=q), table, schema)
        if spec is None:
            return None
        store = WatermarkStore(spark, watermark_path) if watermark_path else None
        return cls(spark, options, spec, keys, store, connections)

    def create(self, recreate: bool = False) -> None:
        """Make the table if it is missing, or drop it and make it anew."""
        run_transaction(self._connect(), create_sql(self.spec, self.keys, recreate))

    @property
    def name(self) -> str:
        return f"{self.spec.schema}.{self.spec.table}"

    def staging_name(self, batch: int) -> str:
        """Batches load side by side, each through a staging table of its own."""
        return f"{self.name}__staging_{batch}"

    def read(self) -> DataFrame:
        return read_jdbc(self.spark, self.options, dbtable=self.name)

    def mark(self, source: str) -> Mark:
        if self.store is not None:
            return self.store.mark(source, self.name)
        run_transaction(self._connect(), [watermarks_sql(self.spec.schema)])
        query = (
            f"SELECT last_value AT TIME ZONE 'UTC' AS last_value, last_rowver FROM {self.spec.schema}.{WATERMARKS} "
            f"WHERE table_name = {_quoted(source)}"
        )
        found = read_jdbc(self.spark, self.options, query=query).first()
        return Mark(found["last_value"], found["last_rowver"]) if found else Mark()

    def stage(
        self,
        df: DataFrame,
        order_by: Sequence[str] = (),
        batches: int = 1,
        batch_by: Column | None = None,
    ) -> StagedDelta:
        path = files.scratch(self.spark, "staged")
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return stage_delta(df, path, self.spec, self.keys, buckets, order_by, batches, batch_by, False, False)

    def load(
        self,
        staged: StagedDelta,
        source: str | None = None,
        mark: Mark | None = None,
        config: SyncConfig = SyncConfig(),
    ) -> LoadSummary:
        """Merge each batch in its own transaction, side by side; the mark follows when all are committed."""
        staged.check_keys()
        columns = [c for c in self.spec.names if c not in staged.absent]

        def one(batch: int, final: bool) -> None:
            name = self.staging_name(batch)
            self._write_staging(staged.batch(batch).select(*columns), name)
            merge = merge_sql(self.spec, name, columns, self.keys)
            statements = [merge, f"DROP TABLE {name}"]
            if final and self.store is None and source is not None and mark is not None:
                statements += [watermarks_sql(self.spec.schema), mark_sql(self.spec.schema, source, mark)]
            run_transaction(self._connect(), statements)

        summary = run_batches(staged.batches, one, config, self.name)
        staged.discard()
        done = summary.chunks_failed == 0 and source is not None and mark is not None
        if done and (self.store is not None or not staged.batches):
            self.record(source, mark)
        return summary

    def record(self, source: str, mark: Mark) -> None:
        """Store the slots of a watermark that changed."""
        if self.store is None:
            run_transaction(self._connect(), [watermarks_sql(self.spec.schema), mark_sql(self.spec.schema, source, mark)])
            return
        stored = self.mark(source)
        if mark.last_value is not None and mark.last_value != stored.last_value:
            self.store.update_timestamp(source, mark.last_value, self.name)
        if mark.last_rowver is not None and mark.last_rowver != stored.last_rowver:
            self.store.update_rowversion(source, mark.last_rowver, self.name)

    def _write_staging(self, rows: DataFrame, name: str) -> None:
        options = {**self.options, "dbtable": name, "numPartitions": str(self.connections)}
        rows.write.format("jdbc").mode("overwrite").options(**options, batchsize="10000").save()

    def _driver_connection(self) -> Any:
        jvm = self.spark._jvm
        jvm.java.lang.Class.forName(self.options["driver"])
        properties = jvm.java.util.Properties()
        for key in ("user", "password"):
            properties.setProperty(key, self.options[key])
        return jvm.java.sql.DriverManager.getConnection(self.options["url"], properties)
