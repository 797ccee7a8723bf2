"""Business jobs composed from operators. Each takes frames and an explicit as-of date."""
