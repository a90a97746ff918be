"""floe.sinks."""
