"""Plans: the proxy star over the driver tables and the query registry."""
