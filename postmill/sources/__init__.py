"""Sources and sinks: driver tables, landed listing JSON, the posts store."""
