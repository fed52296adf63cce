"""Scans and sinks (S1-S18): files, tables, landed API pages."""
