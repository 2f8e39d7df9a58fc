"""Composed plans: the manifest view and the catalogue of registered queries."""
