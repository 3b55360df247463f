"""Whole jobs, and the queries the check runs."""
