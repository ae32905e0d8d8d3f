"""Operators on records and texts for training data; nothing outside this subpackage imports it."""
