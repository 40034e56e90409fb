"""Rank-list analytics warehouse on Spark: clean raw rank observations, derive features, serve reports."""
