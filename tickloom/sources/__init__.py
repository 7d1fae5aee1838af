"""Sources and sinks: flat files, partitioned Parquet, layout, manifests, download."""
