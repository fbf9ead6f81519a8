"""streaming of the observation library."""
