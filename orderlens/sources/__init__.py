"""Readers, and the adapter that derives order entities from star-schema tables."""
