"""Column functions the operators are composed of."""
