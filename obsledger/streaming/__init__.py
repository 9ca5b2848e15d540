"""Micro-batch intake of append-only drops."""
