"""Composed plans: the registered query catalogue, report preparation and
model training."""
