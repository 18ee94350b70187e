"""Readers, writers and the text-record ingestion job."""
