"""Files, paged services and sinks."""
