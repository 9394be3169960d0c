"""Fixed dimensions and the product registry."""
