"""Operators that prepare text and media tables for training language models."""
