"""Sources and sinks: the prospects fixture, CSV / table scans and table writes."""
