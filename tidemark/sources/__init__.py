from tidemark.sources.landing import CSV_OPTIONS, read_landing, read_landing_batches
from tidemark.sources.commits import CommitConflict, expire, step
from tidemark.sources.tables import (append_log, empty_table, publish, read_buckets, read_table, rebucket, replace_log, table_path,
                                     upsert_buckets)

__all__ = ["CSV_OPTIONS", "append_log", "log_path", "empty_table", "publish", "read_landing", "read_landing_batches", "read_table", "table_path", "versions"]
