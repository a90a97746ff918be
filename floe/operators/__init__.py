"""floe.operators."""
