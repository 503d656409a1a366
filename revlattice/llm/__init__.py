"""Operators for training data of language models: filters, near copies, scans, mixing, output."""
