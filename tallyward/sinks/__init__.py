"""Sinks: landing JSON (K1), table overwrite (K2/K3), audit and event-log appends (K4-K6)."""
