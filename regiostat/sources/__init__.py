"""Sources (O-01..O-05) and sinks (O-06..O-10)."""
