from clinflow.sources.ndjson import corrupt_lines, parsed, read_ndjson, split_ndjson
from clinflow.sources.tables import read_parquet_tables, row_count

__all__ = [
    "corrupt_lines", "parsed", "read_ndjson", "read_parquet_tables", "row_count", "split_ndjson"]
