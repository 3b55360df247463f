"""Running the operators on streams."""
