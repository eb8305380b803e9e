"""Registered queries and composite jobs."""
