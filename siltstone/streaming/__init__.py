"""Outcomes as a stream: an extension, as nothing in the model itself streams."""
