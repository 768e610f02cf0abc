"""Column functions: no DataFrame, no state, usable in batch and in streams."""
