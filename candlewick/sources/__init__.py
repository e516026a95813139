"""File readers, table layout and sinks."""
