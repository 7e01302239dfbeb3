"""Column expressions."""

from tablesync.functions.columns import (
    decode_rowversion,
    mark_literal,
    with_defaults,
    with_generated,
    with_rowversion,
)

__all__ = ["decode_rowversion", "mark_literal", "with_defaults", "with_generated", "with_rowversion"]
