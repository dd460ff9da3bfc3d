"""Readers: warehouse tables, ZIP bundles, JSON lines, page images."""
