"""Ordered rule tables and their compilation to Catalyst expressions."""
