"""Bronze, silver and gold tables for a job-market survey, built from Spark DataFrames."""
