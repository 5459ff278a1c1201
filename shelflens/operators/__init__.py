"""DataFrame operators the plans are made of."""
