"""DataFrame to DataFrame operators for cleaning and for analysis."""
