"""Column functions and fixed values shared by the operators."""
