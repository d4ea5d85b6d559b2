"""Sinks: versioned parquet warehouse, CSV export, JDBC staging."""

from starloom.sinks.files import export_csv, export_one_csv
from starloom.sinks.jdbc import jdbc_write_options, stage_star_jdbc, swap_statements
from starloom.sinks.warehouse import (
    create_warehouse,
    current_version,
    publish,
    read_published,
    warehouse_ddl,
)

__all__ = [
    "create_warehouse", "current_version", "export_csv", "jdbc_write_options", "publish",
    "read_published", "stage_star_jdbc", "swap_statements", "warehouse_ddl",
]
