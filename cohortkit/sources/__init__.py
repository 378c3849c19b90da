"""cohortkit.sources."""
