"""Scalar functions as column expressions, and the few that need Python."""
