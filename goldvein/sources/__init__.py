"""Scans, fixture adapters, bronze union and sinks."""
