"""DataFrame -> DataFrame operators: staging, facts, history, dimensions, marts, checks."""
