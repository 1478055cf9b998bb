"""Sources and sinks: landing files, lake tables, JDBC, shared scratch tables."""
