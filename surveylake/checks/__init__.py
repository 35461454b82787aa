"""The survey built from the given tables, the checked queries and their SQL."""
