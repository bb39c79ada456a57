"""DataFrame -> DataFrame operators: flatten, dims, facts, reports, checks."""
