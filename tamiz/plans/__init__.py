"""Ready-made plans built from the operators."""
