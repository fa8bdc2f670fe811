"""Per-area registered queries with their oracles."""
