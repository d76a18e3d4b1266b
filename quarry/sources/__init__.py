"""Readers and writers for the reference file formats."""
