"""Registered queries with their SQL, by layer."""
