from cardlens.sources.buckets import Buckets, join_buckets, open_buckets, save_buckets
from cardlens.sources.jdbc import JdbcOptions, read_jdbc, write_jdbc
from cardlens.sources.json_files import read_dataset
from cardlens.sources.tables import load_all, month_counts, read_table, register, write_table
from cardlens.sources.versions import Store, VersionConflict

__all__ = [
    "Buckets", "JdbcOptions", "Store", "VersionConflict", "join_buckets", "load_all", "month_counts", "open_buckets",
    "read_dataset", "read_jdbc", "read_table", "register", "save_buckets", "write_jdbc", "write_table",
]
