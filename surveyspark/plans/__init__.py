"""The three stages: clean, weight, report."""
