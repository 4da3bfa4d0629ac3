from clinflow.sinks.writers import (
    create_tables, publish, save_bucketed, save_table, write_csv, write_parquet,
)

__all__ = ["create_tables", "publish", "save_bucketed", "save_table", "write_csv",
           "write_parquet"]
