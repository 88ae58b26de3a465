"""Stream sinks and table definitions."""
