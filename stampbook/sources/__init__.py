from stampbook.sources.changes import applied, row_changes
from stampbook.sources.files import catalog_tables, newest_file, read_newest, read_table
from stampbook.sources.maintenance import (
    add_columns,
    append_rows,
    delete_where,
    incremental_start,
    sync_replace,
    upsert,
)
from stampbook.sources.partitions import PeriodTable
from stampbook.sources.staging import shared_folder, staged
from stampbook.sources.versioned import VersionedTable

__all__ = [
    "PeriodTable",
    "applied",
    "row_changes",
    "VersionedTable",
    "add_columns",
    "append_rows",
    "catalog_tables",
    "delete_where",
    "incremental_start",
    "newest_file",
    "read_newest",
    "read_table",
    "shared_folder",
    "staged",
    "sync_replace",
    "upsert",
]
