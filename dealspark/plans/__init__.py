"""Plans: scoring profiles, the layered pipeline and the named query registry."""
