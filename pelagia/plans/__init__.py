"""plans of the observation library."""
