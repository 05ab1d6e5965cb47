"""Sinks: tab-separated row text (K1-K4) and quota messages (K5-K9)."""
