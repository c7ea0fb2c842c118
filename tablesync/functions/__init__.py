"""Column-level building blocks: names and time zones."""
