"""Enrichers: the interface, the factory, and the ones that come with the library."""
