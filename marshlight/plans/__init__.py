"""Composite jobs a user runs: each chains operators into one lazy plan."""
