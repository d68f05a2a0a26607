"""Jobs that move data between layers."""
