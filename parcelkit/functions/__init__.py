"""Column-level functions: every function takes and returns ``Column``."""
