"""Column functions: the row-key contract (query key, Java string hash, salt, prefix)."""
