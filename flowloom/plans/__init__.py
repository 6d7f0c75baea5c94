"""Feature registry, slots, incremental resolution, and the queries that exercise the operators."""
