"""Readers, stored-page extraction and writers."""
