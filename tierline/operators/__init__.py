"""Operators: silver cleaning (T1-T6), gold star schema (G1-G4), quality checks (Q1-Q15),
range-bucketed ordering (keys, ``lead``) and skew-aware joins."""
