"""Jobs: the operators put together the way a user runs them."""
