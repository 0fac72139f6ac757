"""Writers for tiles, results and catalog rows."""
