"""Household-survey analytics on Spark DataFrames."""
