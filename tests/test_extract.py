import datetime as dt

import pytest
from pyspark.sql import functions as F

from sync_helpers import people_frame, rows
from tablesync.frames import local_frame
from tablesync.functions import decode_rowversion, mark_literal, with_defaults, with_generated, with_rowversion
from tablesync.operators import count_since, high_watermark, incremental, reconcile
from tablesync.sources import FileLocation, JdbcSource, TableSource, catalog_query, jdbc_url, read_catalog
from tablesync.sources import jdbc
from tablesync.spec import ColumnSpec, Connection, TargetSpec, load_config, storage_type


def test_full_snapshot_keeps_all_rows_and_columns(spark):
    df = TableSource(people_frame(spark)).by_timestamp("updated_at")
    assert df.count() == 3
    assert df.columns == ["id", "name", "updated_at", "amount"]


def test_incremental_is_strictly_above(spark):
    df = TableSource(people_frame(spark)).by_timestamp("updated_at", dt.datetime(2024, 1, 2))
    assert rows(df, "id") == [(3,)]


def test_upper_bound_leaves_later_rows_for_the_next_run(spark):
    df = incremental(people_frame(spark), "updated_at", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    assert rows(df, "id") == [(2,)]


def test_null_watermark_is_read_by_the_full_load_only(spark):
    df = local_frame(spark, [(1, None), (2, dt.datetime(2024, 1, 2))], "id bigint, w timestamp_ntz")
    assert incremental(df, "w", None, dt.datetime(2024, 1, 2)).count() == 2
    assert incremental(df, "w", dt.datetime(2023, 1, 1)).count() == 1


def test_filter_reaches_the_scan(spark, folder):
    people_frame(spark).write.parquet(folder)
    df = incremental(spark.read.parquet(folder), "updated_at", dt.datetime(2024, 1, 1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at,2024-01-01T00:00)" in plan


def test_microseconds_survive(spark):
    low = dt.datetime(2024, 1, 1, 0, 0, 0, 5)
    df = local_frame(spark, [(low,), (low + dt.timedelta(microseconds=1),)], "w timestamp_ntz")
    assert incremental(df, "w", low).count() == 1


def test_zoned_watermark_loses_its_zone_and_keeps_the_session_clock(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00+05:00' AS w")
    assert high_watermark(df, "w").first()["high"] == dt.datetime(2023, 12, 31, 19)
    assert incremental(df, "w", dt.datetime(2023, 12, 31, 19)).count() == 0
    aware = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    literal = mark_literal(aware, df.schema["w"].dataType)
    assert spark.range(1).select(literal.cast("string")).first()[0] == "2024-01-01 00:00:00"


def test_date_watermark(spark):
    df = spark.sql("SELECT DATE '2024-01-01' AS w UNION ALL SELECT DATE '2024-01-02'")
    assert TableSource(df).window("w") == (dt.datetime(2024, 1, 2), 2)
    assert TableSource(df).window("w", dt.datetime(2024, 1, 1)) == (dt.datetime(2024, 1, 2), 1)
    assert incremental(df, "w", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)).count() == 1


def test_high_watermark_of_nothing_is_null(spark):
    df = people_frame(spark).filter("id > 9")
    assert high_watermark(df, "updated_at").first()["high"] is None


def test_source_that_was_set_back_reports_its_maximum(spark):
    source = TableSource(people_frame(spark))
    assert source.high("updated_at", dt.datetime(2025, 1, 1)) == dt.datetime(2024, 1, 3)


@pytest.mark.parametrize(
    "raw, number",
    [("00000000000003E9", 1001), ("FFFFFFFFFFFFFFFF", -1), ("8000000000000000", -(2**63)), ("7FFFFFFFFFFFFFFF", 2**63 - 1)],
)
def test_rowversion_is_signed(spark, raw, number):
    df = spark.range(1).select(decode_rowversion(F.unhex(F.lit(raw))).alias("v"))
    assert df.first()["v"] == number


def test_rowversion_mode_keeps_the_raw_column(spark):
    df = spark.sql("SELECT 1 AS id, unhex('00000000000003E9') AS rv UNION ALL SELECT 2, unhex('00000000000003EA')")
    full = TableSource(df).by_rowversion("rv")
    assert full.columns == ["id", "rv", "__rowver"]
    assert rows(TableSource(df).by_rowversion("rv", 1001), "id", "__rowver") == [(2, 1002)]


def versions_of(spark, *numbers):
    raw = [(n, bytes((n % 2**64).to_bytes(8, "big"))) for n in numbers]
    return local_frame(spark, raw, "n bigint, rv binary")


@pytest.mark.parametrize("low", [-6, -1, 0, 255, 256, 2**40])
def test_rowversion_filter_is_signed(spark, low):
    numbers = [-(2**63), -5, -1, 0, 1, 255, 256, 257, 2**40, 2**40 + 1, 2**63 - 1]
    source = TableSource(versions_of(spark, *numbers))
    assert [r[0] for r in rows(source.by_rowversion("rv", low), "n")] == [n for n in numbers if n > low]
    assert source.high_rowversion("rv", low) == max((n for n in numbers if n > low), default=None)
    within = [n for n in numbers if low < n <= 5]
    assert [r[0] for r in rows(source.by_rowversion("rv", low, 5), "n")] == within


def test_rowversion_filter_reaches_the_scan(spark, folder):
    versions_of(spark, 1, 2, 3).write.parquet(folder)
    df = TableSource(spark.read.parquet(folder)).by_rowversion("rv", 2)
    assert rows(df, "n") == [(3,)]
    assert "GreaterThan(rv," in df._jdf.queryExecution().executedPlan().toString()


def test_integer_rowversion_is_taken_as_it_is(spark):
    assert with_rowversion(spark.range(3), "id").schema["__rowver"].dataType.simpleString() == "bigint"


def test_generated_column(spark):
    df = with_generated(spark.sql("SELECT 3 AS n, CAST(2.50 AS DECIMAL(12,2)) AS p"), "total", "n * p", "decimal(14,2)")
    assert str(df.first()["total"]) == "7.50"


def test_default_stands_in_for_an_omitted_column_only(spark):
    spec = TargetSpec("t", (ColumnSpec("id", "bigint"), ColumnSpec("n", "integer", default="1"), ColumnSpec("m", "text")))
    given = local_frame(spark, [(1, None)], "id bigint, n int")
    assert with_defaults(given, spec).first().asDict() == {"id": 1, "n": None, "m": None}
    assert with_defaults(given.select("id"), spec).first().asDict() == {"id": 1, "n": 1, "m": None}


def test_counts(spark):
    df = people_frame(spark)
    assert count_since(df, "updated_at", dt.datetime(2024, 1, 2)).first()["n"] == 2
    sides = {r["side"]: (r["n"], r["max_w"]) for r in reconcile(df, df.filter("id < 3"), "updated_at").collect()}
    assert sides == {"source": (3, dt.datetime(2024, 1, 3)), "target": (2, dt.datetime(2024, 1, 2))}


def test_read_error_reaches_the_caller(spark):
    broken = people_frame(spark).withColumn("name", F.raise_error(F.lit("connection lost")).cast("string"))
    with pytest.raises(Exception, match="connection lost"):
        TableSource(broken).by_timestamp("updated_at").collect()


def test_missing_file_reaches_the_caller(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        FileLocation(str(tmp_path)).source(spark, "nothing")


# -- databases: what is sent, since no database runs here ---------------------------------------


def test_urls():
    assert jdbc_url("mssql", "h", 1433, "d") == "jdbc:sqlserver://h:1433;databaseName=d"
    assert jdbc_url("oracle", "h", 1521, "d") == "jdbc:oracle:thin:@//h:1521/d"
    assert jdbc_url("postgresql", "h", 5432, "d") == "jdbc:postgresql://h:5432/d"
    with pytest.raises(ValueError, match="Unsupported dialect: db2"):
        jdbc_url("db2", "h", 1, "d")


def test_config_defaults():
    options = {f"SOURCE_{k}": "x" for k in ("DIALECT", "HOST", "DATABASE", "USER", "PASSWORD")}
    options |= {f"TARGET_{k}": "y" for k in ("HOST", "DATABASE", "USER", "PASSWORD")}
    config = load_config(options)
    assert (config.source.port, config.target.port) == (1433, 5432)
    assert (config.chunk_size, config.max_workers, config.retry_attempts) == (10_000, 4, 5)
    assert "password" not in repr(config.source)
    with pytest.raises(KeyError):
        load_config({})


class FakeReads:
    """Stands in for the JDBC reader: records the options, answers with frames."""

    def __init__(self, answers):
        self.answers, self.calls = answers, []

    def __call__(self, spark, options, **more):
        self.calls.append(more)
        return self.answers(more)


def test_jdbc_read_is_partitioned_and_the_maximum_is_asked_for(spark, monkeypatch):
    def answers(more):
        if "NTILE(8)" in more.get("query", ""):
            return spark.sql("SELECT id AS hi FROM VALUES (100), (7), (NULL), (7), (50) v(id)")
        if "COUNT(" in more.get("query", ""):
            return spark.sql("SELECT 2 AS n")
        if "MAX(" in more.get("query", ""):
            return spark.sql("SELECT TIMESTAMP_NTZ '2024-06-01 12:00:00' AS high")
        return people_frame(spark).toDF("ID", "NAME", "UPDATED_AT", "AMOUNT")

    fake = FakeReads(answers)
    monkeypatch.setattr(jdbc, "read_jdbc", fake)
    monkeypatch.setattr(jdbc, "read_jdbc_split", lambda spark, options, predicates, **more: fake(spark, options, predicates=predicates, **more))
    source = JdbcSource(spark, {"url": "u"}, "ventas", "oracle", "id", 8, "ID BIGINT")
    assert source.high("updated_at") == dt.datetime(2024, 6, 1, 12)
    assert source.window("updated_at", dt.datetime(2024, 1, 1)) == (dt.datetime(2024, 6, 1, 12), 2)
    assert fake.calls[-1]["query"] == (
        "SELECT COUNT(*) AS n FROM ventas WHERE updated_at > TIMESTAMP '2024-01-01 00:00:00'"
    )
    delta = source.by_timestamp("updated_at", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    assert delta.columns == ["id", "name", "updated_at", "amount"]
    relation = (
        "(SELECT * FROM ventas WHERE updated_at > TIMESTAMP '2024-01-01 00:00:00' "
        "AND updated_at < TIMESTAMP '2024-01-02 00:00:00.000001') q"
    )
    assert fake.calls[-1] == {
        "dbtable": relation, "customSchema": "ID BIGINT", "predicates": ["(id <= 7 OR id IS NULL)", "id > 7 AND id <= 50", "id > 50"],
    }
    assert fake.calls[-2]["query"] == (
        f"SELECT MAX(v) AS hi FROM (SELECT id AS v, NTILE(8) OVER (ORDER BY id) AS tile FROM {relation} WHERE id IS NOT NULL) q GROUP BY tile"
    )


@pytest.mark.parametrize(
    "kind, value",
    [
        ("BIGINT", "CAST(exp(i / 60.0) AS BIGINT)"),  # numbers that grow exponentially
        ("DOUBLE", "CASE WHEN i % 50 = 0 THEN 1e12 ELSE i / 7.0 END"),
        ("DECIMAL(20,4)", "CAST(i * i * 0.25 AS DECIMAL(20,4))"),
        ("VARCHAR", "'it''s ' || lpad(CAST(i * 37 % 1000 AS VARCHAR), 6, '0')"),
        ("TIMESTAMP", "TIMESTAMP '2024-01-01' + to_microseconds(i * i * i)"),
        ("BIGINT", "CASE WHEN i < 300 THEN 5 ELSE i END"),  # one value with a third of the rows
    ],
)
def test_ranges_hold_equal_shares_of_skewed_keys(spark, kind, value):
    """The statements run in an engine in this process; every row meets one condition, NULLs included."""
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    db.execute(f"CREATE TABLE t AS SELECT CAST({value} AS {kind}) AS k FROM range(1000) r(i) UNION ALL SELECT NULL FROM range(20)")
    source = JdbcSource(spark, {"url": "u"}, "t", "postgresql", "k", 8)
    tops = [r[0] for r in db.execute(source.bounds_query("t")).fetchall()]
    predicates = jdbc.split_predicates("postgresql", "k", tops)
    counts = [db.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in predicates]
    nulls = [db.execute(f"SELECT count(*) FROM t WHERE k IS NULL AND {p}").fetchone()[0] for p in predicates]
    assert sum(counts) == 1020 and sorted(nulls) == [0] * (len(predicates) - 1) + [20]
    hot = db.execute("SELECT max(n) FROM (SELECT count(*) AS n FROM t WHERE k IS NOT NULL GROUP BY k) q").fetchone()[0]
    mean = 1020 / 8
    assert max(counts) <= max(2 * mean, hot + mean + 20)


def test_what_cannot_be_split_is_read_whole():
    assert jdbc.split_predicates("oracle", "k", [5, 5, None]) == []
    assert jdbc.split_predicates("oracle", "k", []) == []
    assert jdbc.split_predicates("oracle", "k", [b"a", b"b"]) == []


@pytest.mark.parametrize("dialect", ["oracle", "mssql", "postgresql"])
def test_the_source_filters_the_timestamp_itself(spark, monkeypatch, dialect):
    """No date-time is left for Spark's dialect to write, and finer digits than microseconds stay within the bound."""
    fake = FakeReads(lambda more: people_frame(spark))
    monkeypatch.setattr(jdbc, "read_jdbc", fake)
    source = JdbcSource(spark, {"url": "u"}, "t", dialect)
    high = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    delta = source.by_timestamp("w", dt.datetime(2024, 1, 1), high)
    assert "Filter" not in delta._jdf.queryExecution().optimizedPlan().toString()
    text = fake.calls[-1]["dbtable"]
    assert "2024-01-02 03:04:05.123457" in text and ("datetime2" in text) == (dialect == "mssql")
    source.by_timestamp("w", None, high)
    assert fake.calls[-1]["dbtable"].endswith("OR w IS NULL)) q")
    source.by_timestamp("w")
    assert fake.calls[-1]["dbtable"] == "t"


def test_date_watermarks_and_decimal_bounds(spark, monkeypatch):
    def answers(more):
        if "NTILE(" in more.get("query", ""):
            return spark.sql("SELECT CAST(id AS DECIMAL(38, 10)) AS hi FROM VALUES (1), (90) v(id)")
        return spark.sql("SELECT DATE '2024-05-06' AS high") if "query" in more else people_frame(spark)

    fake = FakeReads(answers)
    monkeypatch.setattr(jdbc, "read_jdbc", fake)
    monkeypatch.setattr(jdbc, "read_jdbc_split", lambda spark, options, predicates, **more: fake(spark, options, predicates=predicates, **more))
    source = JdbcSource(spark, {"url": "u"}, "t", "oracle", "id", 4)
    assert source.high("w") == dt.datetime(2024, 5, 6)
    source.by_timestamp("w", dt.date(2024, 5, 1), source.high("w"))
    assert "TIMESTAMP '2024-05-01 00:00:00'" in fake.calls[-1]["dbtable"]
    assert fake.calls[-1]["predicates"] == ["(id <= 1.0000000000 OR id IS NULL)", "id > 1.0000000000"]


def test_mssql_converts_and_filters_the_rowversion_itself(spark, monkeypatch):
    fake = FakeReads(lambda more: spark.sql("SELECT 2 AS id, 1002L AS __rowver"))
    monkeypatch.setattr(jdbc, "read_jdbc", fake)
    source = JdbcSource(spark, {"url": "u"}, "accounts", "mssql")
    assert rows(source.by_rowversion("rowver", 1001), "id") == [(2,)]
    assert fake.calls[-1]["dbtable"] == (
        "(SELECT t.*, CONVERT(BIGINT, rowver) AS __rowver FROM accounts t WHERE CONVERT(BIGINT, rowver) > 1001 "
        "AND rowver > CONVERT(BINARY(8), CAST(1001 AS BIGINT))) q"
    )
    source.by_rowversion("rowver")
    assert fake.calls[-1]["dbtable"] == "(SELECT t.*, CONVERT(BIGINT, rowver) AS __rowver FROM accounts t) q"
    source.by_rowversion("rowver", -3)
    assert fake.calls[-1]["dbtable"].endswith("WHERE CONVERT(BIGINT, rowver) > -3) q")
    source.by_rowversion("rowver", 5, 9)
    assert fake.calls[-1]["dbtable"].endswith("AND CONVERT(BIGINT, rowver) <= 9) q")
    source.by_rowversion("rowver", None, 9)
    assert fake.calls[-1]["dbtable"].endswith("WHERE (CONVERT(BIGINT, rowver) <= 9 OR rowver IS NULL)) q")
    assert source.high_rowversion("rowver", 5) == 2
    assert fake.calls[-1]["query"].startswith("SELECT MAX(__rowver) AS high FROM (SELECT")


def test_options_carry_fetch_size_and_zone_free_timestamps():
    options = jdbc.jdbc_options(Connection("oracle", "h", 1521, "d", "u", "p"), 500)
    assert options["fetchsize"] == "500"
    assert options["preferTimestampNTZ"] == "true"
    assert options["driver"] == "oracle.jdbc.OracleDriver"


CATALOG_SCHEMA = (
    "column_name string, data_type string, is_nullable string, column_default string, "
    "ordinal_position int, numeric_precision int, numeric_scale int"
)


def test_catalogue_is_read_in_order(spark):
    found = [
        ("price", "NUMERIC", "NO", None, 2, 12, 2),
        ("id", "integer", "NO", "nextval('s')", 1, 32, 0),
        ("note", "text", "yes", None, 3, None, None),
    ]
    spec = read_catalog(lambda q: local_frame(spark, found, CATALOG_SCHEMA), "t")
    listed = [tuple(r) for r in spec.catalog(spark).collect()]
    assert listed == [
        ("id", "integer", False, True, 1),
        ("price", "numeric(12,2)", False, False, 2),
        ("note", "text", True, False, 3),
    ]
    assert spec.struct()["price"].dataType.simpleString() == "decimal(12,2)"


def test_empty_catalogue_means_no_table(spark):
    assert read_catalog(lambda q: local_frame(spark, [], CATALOG_SCHEMA), "t") is None


def test_catalogue_query_quotes_names():
    assert "table_name = 'o''brien'" in catalog_query("o'brien")


def test_storage_types():
    assert storage_type("Character Varying(20)").simpleString() == "string"
    assert storage_type("numeric(14, 2)").simpleString() == "decimal(14,2)"
    assert storage_type("numeric").simpleString() == "decimal(38,18)"
    assert storage_type("timestamp(6) with time zone").simpleString() == "timestamp_ntz"
