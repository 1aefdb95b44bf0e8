"""State-level public-health tables and reports as lazy Spark plans."""
