"""End-to-end analyses."""
