"""Live order streams."""
