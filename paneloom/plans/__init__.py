"""Declared feature plans and the end-to-end compositions."""
