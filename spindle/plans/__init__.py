"""User-level jobs and the registered queries with their oracle SQL."""
