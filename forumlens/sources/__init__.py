"""Readers and writers for landed posts and comments."""
