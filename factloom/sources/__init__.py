"""Readers of inline-tagged documents, linkbases, index pages and section text."""
