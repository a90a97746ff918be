"""floe.plans."""
