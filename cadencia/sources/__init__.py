"""Report readers, landing and sinks."""
