"""Preparation of training text: filters, scans, deduplication and tokenising."""
