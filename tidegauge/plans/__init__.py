"""Complete computations composed of the operators."""
