"""Column-level building blocks: dates, tile grid, row keys, pixels, text."""
