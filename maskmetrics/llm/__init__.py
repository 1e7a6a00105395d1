"""Operators that prepare text for training: rules, shards, formats, token files, near duplicates."""
