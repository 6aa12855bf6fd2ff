"""Whole jobs assembled from the operators, with every path an argument."""
