"""Readers, writers and row contracts of the pipeline layers."""
