"""Jobs that combine sources, operators and tables."""
