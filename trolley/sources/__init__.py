"""Scans: nested payloads, staged files, processed and serving tables."""
