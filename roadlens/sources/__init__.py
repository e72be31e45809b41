"""Readers (A*) and writers (B*)."""
