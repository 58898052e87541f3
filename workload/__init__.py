"""The travel-time model laid over the given tables, with its queries."""
