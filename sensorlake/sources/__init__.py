"""Sources and sinks: landing text files, historical CSV, lakehouse tables."""
