"""Scans: manifest, header probe, CSV drops, needs lists, the table."""
