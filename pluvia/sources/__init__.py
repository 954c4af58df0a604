"""pluvia.sources."""
