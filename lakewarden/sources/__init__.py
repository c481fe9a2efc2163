"""Readers and parsers: landed files, manifests, catalog pages, change feeds, deliveries."""
