"""sources of the observation library."""
