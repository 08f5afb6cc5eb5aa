"""Column-level helpers: text, codes and dates."""
