"""Ingestion and storage."""
