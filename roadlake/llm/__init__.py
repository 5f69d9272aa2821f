"""Operators for preparing training text: cleaning, deduplication, formatting, mixing and sharding."""
