"""Readers and writers of raw entity data."""
