"""Readers, table maintenance and stored postings."""
