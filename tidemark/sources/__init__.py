"""Entity registry, landing of JSON and change events, and the adapter of the star-schema tables."""
