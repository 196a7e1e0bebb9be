"""Sources: message logs, files, keyed tables."""
