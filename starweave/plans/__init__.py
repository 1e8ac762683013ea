"""Composite dataflows: dimensions, facts, normalisation, cleaning."""
