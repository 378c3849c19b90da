"""Stand-in plans: the reference's analyses wired to the driver's tables."""
