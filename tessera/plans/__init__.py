"""Composed plans: the target runner (P1) and the registered query catalog."""
