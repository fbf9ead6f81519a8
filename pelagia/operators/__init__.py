"""operators of the observation library."""
