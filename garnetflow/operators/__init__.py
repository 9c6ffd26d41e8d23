"""DataFrame operators, a module for each family."""
