"""Readers, writers and the directory layout of the three data layers."""
