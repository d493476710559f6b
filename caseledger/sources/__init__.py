"""Readers and writers at the engine's boundary."""
