"""Composite plans and the step registry."""
