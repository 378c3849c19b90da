"""cohortkit.functions."""
