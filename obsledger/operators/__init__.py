"""Relational operators over observations."""
