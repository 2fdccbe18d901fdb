"""Readers, writers and the adapter from star-schema tables to a sales panel."""
