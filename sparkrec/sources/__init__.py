"""Readers, sinks, fixtures and the model store."""
