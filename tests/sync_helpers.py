"""What the tests of the sync share: one small table and a way to compare rows."""

from __future__ import annotations

import datetime as dt

from tablesync.frames import local_frame
from tablesync.spec import ColumnSpec, TargetSpec

PEOPLE = TargetSpec(
    "people",
    (
        ColumnSpec("id", "integer", nullable=False),
        ColumnSpec("name", "character varying"),
        ColumnSpec("updated_at", "timestamp with time zone", nullable=False),
        ColumnSpec("amount", "double precision"),
    ),
)
PEOPLE_ROWS = [
    (1, "Ines", dt.datetime(2024, 1, 1), 12.5),
    (2, "Jarl", dt.datetime(2024, 1, 2), 7.0),
    (3, "Kofi", dt.datetime(2024, 1, 3), 30.25),
]
PEOPLE_SCHEMA = "id bigint, name string, updated_at timestamp_ntz, amount double"


def people_frame(spark, rows=PEOPLE_ROWS):
    return local_frame(spark, rows, PEOPLE_SCHEMA)


def rows(df, *order):
    return sorted(tuple(r) for r in df.select(*(order or df.columns)).collect())
