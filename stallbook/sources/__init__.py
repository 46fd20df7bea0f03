"""Readers and writers of slices, tables and documents."""
