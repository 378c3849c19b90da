"""cohortkit.operators."""
