"""Readers, sinks and the adapter that shapes the driver tables into raw commerce tables."""
