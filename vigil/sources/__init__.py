"""Sources and sinks: landing JSON, the partitioned raw store, TSV stages."""
