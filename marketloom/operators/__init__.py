"""DataFrame operators; each is a function of a DataFrame and parameters."""
