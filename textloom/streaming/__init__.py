"""textloom streaming."""
