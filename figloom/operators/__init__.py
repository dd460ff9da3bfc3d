"""Relational and document operators built from DataFrame expressions."""
