"""Scans and sources: landed payloads, parsing, fixture mapping, time-bounded scans."""
