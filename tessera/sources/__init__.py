"""Readers, keyed tables, the ranked store, fixtures and seeded generation."""
