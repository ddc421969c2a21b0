"""DataFrame-in, DataFrame-out operators. Each module documents its inventory IDs."""
