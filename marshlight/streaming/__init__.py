"""Incremental loading. There is no unbounded stream in this domain; data arrives period by period."""
