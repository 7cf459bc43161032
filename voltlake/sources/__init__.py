"""Readers: raw snapshots, delimited files, POI features."""
