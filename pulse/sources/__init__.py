"""Sources and sinks: stand-in inputs, landing, and stored-table helpers."""
