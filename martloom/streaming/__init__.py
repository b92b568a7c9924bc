"""Live windows over event streams, and their sinks."""
