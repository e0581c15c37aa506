"""Sources and sinks: captured pages, embedded JSON, fixed-header CSV."""
