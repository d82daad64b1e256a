"""Readers and writers for trip, weather and zone files; stand-in views."""
