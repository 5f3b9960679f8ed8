"""Column and DataFrame functions without I/O."""
