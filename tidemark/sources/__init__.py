"""Topics, the driver's tables, and catalog settings."""
