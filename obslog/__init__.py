"""Operators for analytics on an append-only log of JSON observations."""
