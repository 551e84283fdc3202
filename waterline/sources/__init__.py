"""Readers, source normalisation and writers."""
