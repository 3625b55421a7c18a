"""Snapshots, polls, change feeds and readers of written tables."""
