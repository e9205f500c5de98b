"""Quarterly panel analytics on Spark: one row per entity and fiscal quarter."""
