"""Source registry, lookups, session settings and sinks."""
