"""Registered queries with their checking SQL, and the monthly jobs."""
