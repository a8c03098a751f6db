"""Composed jobs and the registered query catalogue."""
