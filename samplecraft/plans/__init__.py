"""Plans: the fixed-order composition of the operators."""
