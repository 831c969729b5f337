"""Compositions of operators: hybrid retrieval, routing, search responses."""
