"""Where rows come from: raw CSV files, the Parquet lake, the shared test tables."""

from basket_marts.sources.lake import Lake
from basket_marts.sources.partitioned import PartitionedTable
from basket_marts.sources.raw_files import RawFiles, read_csv, read_csv_audited
from basket_marts.sources.shared_tables import SharedTables

__all__ = ["Lake", "PartitionedTable", "RawFiles", "SharedTables", "read_csv", "read_csv_audited"]
