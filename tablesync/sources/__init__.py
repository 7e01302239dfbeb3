"""Where rows come from."""

from tablesync.sources.catalog import catalog_query, read_catalog
from tablesync.sources.frames import FileLocation, TableSource
from tablesync.sources.jdbc import JdbcLocation, JdbcSource, jdbc_url, read_jdbc

__all__ = [
    "FileLocation",
    "JdbcLocation",
    "JdbcSource",
    "TableSource",
    "catalog_query",
    "jdbc_url",
    "read_catalog",
    "read_jdbc",
]
