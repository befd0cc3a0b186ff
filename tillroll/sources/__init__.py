"""Sources: driver Parquet readers, reference schemas and the binding layer."""
