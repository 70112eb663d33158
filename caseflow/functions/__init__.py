"""Column-level helpers: repeatable uniforms, time arithmetic, code tables."""
