"""Whole layers: raw to silver, silver to gold, and the jobs that run them."""
