"""Query registry and oracle SQL."""
