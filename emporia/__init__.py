"""emporia package."""
