"""Helpers around plans: cutting lineage through shared storage."""
