"""Spark jobs for the sentiment of social posts about markets."""
