"""Sources and sinks: typed file scans, landing writes, partitioned tables."""
