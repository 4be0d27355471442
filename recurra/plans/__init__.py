"""Dimensions, facts, KPI queries, views and checks built from the operators."""
