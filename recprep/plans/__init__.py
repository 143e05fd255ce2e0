"""Whole datasets: one row per (customer, product) from flat and nested sources, and the build."""
