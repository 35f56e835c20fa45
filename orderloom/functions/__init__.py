"""Column helpers and the skew-safe global ordering."""
