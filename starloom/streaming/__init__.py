"""Feeds followed as streams."""
