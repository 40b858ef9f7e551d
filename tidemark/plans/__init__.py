"""Reports and live figures, and the registry that runs them on the given tables."""
