"""Column-level helpers: scalar expressions, text cleaning."""
