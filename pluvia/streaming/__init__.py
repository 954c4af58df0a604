"""pluvia.streaming."""
