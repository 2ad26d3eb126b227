"""Intentionally empty: the described workload has no streaming operator."""
