from cartledger.sources.catalog import read_catalog
from cartledger.sources.readers import (
    FILE_POSITION,
    REJECTED,
    read_csv,
    read_jdbc,
    read_parquet,
    run_query,
    with_file_position,
)
from cartledger.sources.schemas import TABLES, TableSource
from cartledger.sources.scratch import run_folder, scratch_path

__all__ = [
    "FILE_POSITION",
    "REJECTED",
    "TABLES",
    "TableSource",
    "read_catalog",
    "read_csv",
    "read_jdbc",
    "read_parquet",
    "run_folder",
    "run_query",
    "scratch_path",
    "with_file_position",
]
