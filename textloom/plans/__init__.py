"""textloom plans."""
