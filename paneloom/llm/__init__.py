"""Operators for preparing training data: filtering, tokenizing, near duplicates, sharding, packing, archives."""
