"""Spark jobs for charging-infrastructure occupancy data and points of interest."""
