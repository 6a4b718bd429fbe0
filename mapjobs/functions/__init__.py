"""Column functions: tag rules, geometry, text."""
