"""Jobs over tiles that keep arriving."""
