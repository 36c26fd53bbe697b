"""Readers, writers, manifests and acquisition."""
