"""Recurring-revenue analytics as Spark DataFrames."""
