"""The same load as a stream of micro-batches."""

from tablesync.streaming.available_now import sync_available_now

__all__ = ["sync_available_now"]
