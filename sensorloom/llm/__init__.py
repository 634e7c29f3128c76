"""Operators over text corpora: filters, near-duplicates, personal data, tokens and pages."""
