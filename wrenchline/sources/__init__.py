"""Where lines and lookups come from, and where reports go."""
