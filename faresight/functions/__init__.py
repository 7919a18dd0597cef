"""Column expressions (scalar functions F1–F22) and metric aggregates (V1)."""
