"""Sources and sinks: file directories, tables, CSV exports, artifacts."""
