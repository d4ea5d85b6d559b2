"""Sources: driver-table fixtures, CSV/parquet files, JDBC."""

from starloom.sources.files import (
    create_landing_table,
    read_awards_csv,
    read_stage,
    read_tracks,
    write_stage,
)
from starloom.sources.fixtures import raw_awards, raw_tracks, table
from starloom.sources.jdbc import jdbc_bounds, jdbc_read_options, read_awards_jdbc

__all__ = [
    "create_landing_table", "jdbc_bounds", "jdbc_read_options", "raw_awards", "raw_tracks",
    "read_awards_csv", "read_awards_jdbc", "read_stage", "read_tracks", "table",
    "write_stage",
]
