"""Operators over works, outcomes, documents and their assets."""
