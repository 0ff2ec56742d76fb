"""Compositions of the operators: weekly features, and a whole forecasting run."""
