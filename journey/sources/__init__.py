"""Sources, sinks and the benchmark-table adapter."""

from journey.sources.io import Tables, load_tables, read_csv, write_csv, write_parquet, dataset_summary
