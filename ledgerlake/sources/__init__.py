"""Readers and writers for landed pages, flat files and materialised tables."""
