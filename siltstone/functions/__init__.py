"""Scalar functions over text, addresses, names, hashes and verdicts, as Columns."""
