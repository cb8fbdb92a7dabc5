"""DataFrame operators; every one is lazy and works on long, cell-keyed tables."""
