"""Composite jobs (the reference's three programs)."""
