"""Column functions and ordered-scan helpers shared by the operators."""
