"""floe.sources."""
