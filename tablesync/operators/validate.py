"""Checks of a source frame against its target's catalogue entry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.frames import local_frame
from tablesync.functions.columns import ROWVER
from tablesync.operators.chunks import first_chunk
from tablesync.spec import TargetSpec

ISSUE_COLUMNS = ("severity", "column_name", "kind", "detail", "nulls")

# The parts of a declared type name that a source type may be stored in.
ACCEPTED_BY = {
    "integer": ("smallint", "integer", "bigint", "numeric", "serial"),
    "long": ("smallint", "integer", "bigint", "numeric", "int8", "serial", "real", "float", "double"),
    "floating": ("real", "float", "double", "numeric"),
    "text": ("char", "text", "varchar", "uuid", "json", "xml"),
    "boolean": ("bool",),
    "binary": ("bytea",),
    "temporal": ("timestamp", "date", "time"),
    "interval": ("interval",),
    "decimal": ("numeric", "decimal", "real", "float", "double"),
    "nested": ("json", "text", "char", "xml"),
}

FAMILIES = (
    ((T.ByteType, T.ShortType, T.IntegerType), "integer"),
    ((T.LongType,), "long"),
    ((T.FloatType, T.DoubleType), "floating"),
    ((T.StringType, T.VarcharType, T.CharType), "text"),
    ((T.BooleanType,), "boolean"),
    ((T.BinaryType,), "binary"),
    ((T.DateType, T.TimestampType, T.TimestampNTZType, T.TimeType), "temporal"),
    ((T.DayTimeIntervalType,), "interval"),
    ((T.DecimalType,), "decimal"),
)


def type_family(data_type: T.DataType) -> str:
    """The rule a Spark type falls under; whatever has none goes with the nested types."""
    return next((name for classes, name in FAMILIES if isinstance(data_type, classes)), "nested")


def _rules(spark: SparkSession) -> DataFrame:
    rows = [(family, list(parts)) for family, parts in ACCEPTED_BY.items()]
    return local_frame(spark, rows, "family string, accepts array<string>")


def _compatible(data_type: Column, accepts: Column) -> Column:
    return F.exists(accepts, lambda part: F.contains(data_type, part))


def type_matrix(spark: SparkSession, types: Mapping[str, T.DataType], targets: Sequence[str]) -> DataFrame:
    """For each named source type and declared target type, whether one can be stored in the other."""
    sources = local_frame(
        spark, [(name, type_family(t)) for name, t in types.items()], "spark_type string, family string"
    )
    pairs = sources.join(_rules(spark), "family").select(
        "spark_type", "accepts", F.explode(F.array(*map(F.lit, targets))).alias("pg_type")
    )
    return pairs.select(
        "spark_type", "pg_type", _compatible(F.col("pg_type"), F.col("accepts")).alias("compatible")
    )


def _schema_issues(spark: SparkSession, schema: T.StructType, spec: TargetSpec) -> DataFrame:
    """One full join of the two column lists; a column raises at most one of these issues."""
    found = [(f.name, f.dataType.simpleString(), type_family(f.dataType)) for f in schema if f.name != ROWVER]
    source = local_frame(spark, found, "column_name string, source_type string, family string")
    pairs = source.join(spec.catalog(spark), "column_name", "full_outer").join(_rules(spark), "family", "left")
    name, declared = F.col("column_name"), F.col("data_type")
    absent, unknown = F.col("source_type").isNull(), declared.isNull()
    optional = F.col("is_nullable") | F.col("has_default")
    fits = F.coalesce(_compatible(declared, F.col("accepts")), F.lit(False))

    def issue(phase: int, severity: str, kind: str, text: str, *values: Column) -> Column:
        return F.struct(
            F.lit(phase).alias("phase"),
            F.lit(severity).alias("severity"),
            F.lit(kind).alias("kind"),
            F.format_string(text, *values).alias("detail"),
        )

    issues = (
        F.when(
            absent & ~optional,
            issue(1, "error", "missing_required", "NOT NULL column '%s' has no default and is absent.", name),
        )
        .when(
            absent,
            issue(1, "warning", "missing_optional", "Column '%s' is absent; it keeps its value or default.", name),
        )
        .when(
            unknown,
            issue(
                2,
                "warning",
                "extra_column",
                "Column '%s' is not in '%s'; it is not loaded.",
                name,
                F.lit(f"{spec.schema}.{spec.table}"),
            ),
        )
        .when(
            ~fits,
            issue(3, "error", "type_mismatch", "Source type '%s' cannot be stored as '%s'.", F.col("source_type"), declared),
        )
    )
    return pairs.select("column_name", "ordinal_position", issues.alias("issue")).filter("issue is not null").select(
        "issue.phase",
        F.when(F.col("issue.phase") == 1, F.col("ordinal_position")).otherwise(F.lit(0)).alias("position"),
        "column_name",
        F.lit(0).alias("step"),
        "issue.severity",
        "issue.kind",
        "issue.detail",
        F.lit(None).cast("bigint").alias("nulls"),
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, nulls)`` for the named columns, from one pass over them."""
    if not columns:
        return local_frame(df.sparkSession, [], "column_name string, nulls bigint")
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("nulls")) for c in columns
    ]
    return df.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs"))


def _null_issues(nulls: DataFrame) -> DataFrame:
    text = "Column '%s' is NOT NULL in the target but the source holds %d NULL(s)."
    return nulls.filter("nulls > 0").select(
        F.lit(3).alias("phase"),
        F.lit(0).cast("bigint").alias("position"),
        "column_name",
        F.lit(1).alias("step"),
        F.lit("error").alias("severity"),
        F.lit("nullable_violation").alias("kind"),
        F.format_string(text, F.col("column_name"), F.col("nulls")).alias("detail"),
        "nulls",
    )


def _report(issues: DataFrame) -> DataFrame:
    """In the order of the checks: missing columns as declared, extra ones by name, then for each
    shared column its type before its NULLs."""
    return issues.orderBy("phase", "position", "column_name", "step").select(*ISSUE_COLUMNS)


def table_not_found(spark: SparkSession, name: str) -> DataFrame:
    detail = f"Table '{name}' is not in the catalogue (check name, schema and permissions)."
    return local_frame(
        spark,
        [("error", "*", "table_not_found", detail, None)],
        "severity string, column_name string, kind string, detail string, nulls bigint",
    )


def schema_issues(spark: SparkSession, schema: T.StructType, spec: TargetSpec | None, name: str = "") -> DataFrame:
    """The checks that need no rows. Without a catalogue entry the only issue is the missing table."""
    if spec is None or not spec.columns:
        return table_not_found(spark, name)
    return _report(_schema_issues(spark, schema, spec))


def null_issues(nulls: DataFrame) -> DataFrame:
    """Violations from NULL counts that were taken elsewhere."""
    return _report(_null_issues(nulls))


def validate(
    df: DataFrame,
    spec: TargetSpec | None,
    scope: str = "all",
    watermark_col: str | None = None,
    keys: Sequence[str] = (),
    chunk_size: int = 10_000,
    name: str = "",
) -> DataFrame:
    """All issues as rows ``(severity, column_name, kind, detail, nulls)``.

    The NULL checks read every row (``all``), the first chunk in watermark order (``first_chunk``)
    or nothing (``schema``), and only the NOT NULL columns.
    """
    spark = df.sparkSession
    if spec is None or not spec.columns:
        return table_not_found(spark, name)
    issues = _schema_issues(spark, df.schema, spec)
    required = [c for c in spec.required if c in df.columns]
    if scope != "schema" and required:
        rows = first_chunk(df, watermark_col, keys, chunk_size) if scope == "first_chunk" else df
        issues = issues.unionByName(_null_issues(null_counts(rows, required)))
    return _report(issues)


# How a summary reads.
SUMMARY_PASSED, SUMMARY_FAILED = "PASS (warnings=%d)", "FAIL — "


def summarize(issues: DataFrame) -> DataFrame:
    """One row: ``valid``, the numbers of errors and warnings, and the summary text."""
    failed = F.col("severity") == "error"
    numbered = issues.withColumn("__i", F.monotonically_increasing_id())
    # At most a few issues per column of the table.
    texts = F.array_sort(
        F.collect_list(F.when(failed, F.struct("__i", F.concat_ws(":", "kind", "column_name").alias("text"))))
    )
    counted = numbered.agg(
        F.count_if(failed).alias("errors"), F.count_if(~failed).alias("warnings"), texts.alias("texts")
    )
    passed = F.format_string(SUMMARY_PASSED, F.col("warnings"))
    broken = F.concat(F.lit(SUMMARY_FAILED), F.array_join(F.col("texts.text"), "; "))
    valid = F.col("errors") == 0
    return counted.select(
        valid.alias("valid"), "errors", "warnings", F.when(valid, passed).otherwise(broken).alias("summary")
    )


@dataclass(frozen=True)
class ValidationResult:
    """Collected issues; there are only a few per column."""

    issues: tuple[Row, ...]

    @classmethod
    def of(cls, issues: DataFrame) -> ValidationResult:
        return cls(tuple(issues.collect()))

    @property
    def errors(self) -> list[Row]:
        return [i for i in self.issues if i.severity == "error"]

    @property
    def warnings(self) -> list[Row]:
        return [i for i in self.issues if i.severity == "warning"]

    @property
    def valid(self) -> bool:
        return not self.errors

    def listed(self, pattern: str) -> str:
        """The errors in one text; ``pattern`` is a format of an issue's columns."""
        return "; ".join(pattern.format(**error.asDict()) for error in self.errors)

    def summary(self) -> str:
        passed = SUMMARY_PASSED % len(self.warnings)
        return passed if self.valid else SUMMARY_FAILED + self.listed("{kind}:{column_name}")

    def check(self) -> None:
        """Raise unless there are only warnings."""
        if self.errors:
            raise SchemaValidationError(self)


class SchemaValidationError(ValueError):
    """Raised before anything is written; carries the issues."""

    def __init__(self, result: ValidationResult) -> None:
        super().__init__("Schema validation failed: " + result.listed("[{kind}] {column_name}: {detail}"))
        self.result = result
