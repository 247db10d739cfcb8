"""Readers, tables, staged files and stored models."""
