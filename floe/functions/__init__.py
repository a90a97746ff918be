"""floe.functions."""
