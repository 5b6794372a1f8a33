"""Sources and sinks: tables, CSV, result files, run logs, model settings."""
