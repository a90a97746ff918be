"""floe.streaming."""
