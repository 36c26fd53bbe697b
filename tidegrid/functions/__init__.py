"""Column builders: masks, numbers, bins and exponential weights."""
