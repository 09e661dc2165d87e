"""Outputs as files."""
