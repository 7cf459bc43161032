"""Whole jobs: the star schema, the bindings to the given tables, the registered queries."""
