"""Readers of the source files and writers of the layers."""
