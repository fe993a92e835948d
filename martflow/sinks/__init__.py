"""Where records go."""
