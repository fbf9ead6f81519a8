"""functions of the observation library."""
