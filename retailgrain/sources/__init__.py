from retailgrain.sources.readers import (
    SALES_FACT_SCHEMA,
    STOCK_SCHEMA,
    read_channel_sessions,
    read_orders,
    read_sales_facts,
    read_snapshot,
    read_stock_files,
    read_table,
)
from retailgrain.sources.sinks import (
    PERSONAL_COLUMNS,
    append_rows,
    create_table,
    delete_not_null,
    publish_version,
    replace_rows,
    write_csv,
    write_recon_export,
)
from retailgrain.sources.snapshots import invalidate_after, snapshot_if_stale

__all__ = [
    "PERSONAL_COLUMNS",
    "SALES_FACT_SCHEMA",
    "STOCK_SCHEMA",
    "append_rows",
    "create_table",
    "delete_not_null",
    "invalidate_after",
    "publish_version",
    "read_channel_sessions",
    "read_orders",
    "read_sales_facts",
    "read_snapshot",
    "read_stock_files",
    "read_table",
    "replace_rows",
    "snapshot_if_stale",
    "write_csv",
    "write_recon_export",
]
