"""Column functions: vectors, tokens, scenes, conditions."""
