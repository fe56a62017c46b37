"""Financial computations composed from the generic operators."""
