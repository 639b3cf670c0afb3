"""Readers: landing files, status logs, stored tables, topics and snapshots."""
