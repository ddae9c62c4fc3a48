"""Muster: longitudinal analysis of repeatedly published registry snapshots, on Spark."""
