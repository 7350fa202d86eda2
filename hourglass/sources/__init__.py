"""Readers and writers (S1-S8): ``hourglass.sources.io``."""
