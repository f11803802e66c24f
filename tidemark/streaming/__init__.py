"""Continuous landing of change events."""
