"""Operators: control (load specs, high-water mark, load selection), archive,
silver (V1-V7) and gold (G1-G5)."""
