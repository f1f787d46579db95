"""Sources: each gives a frame with a ``value`` column, or a named view."""
