"""Column-level scalar functions (string, date, math, JSON, acoustics)."""
