"""Operators: DataFrame in, DataFrame out, or a ``fit`` that returns a state."""
