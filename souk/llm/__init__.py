"""Operators for training-data pipelines: tokens, duplicates, secrets, fingerprints, chats, toxicity, pages and leaks."""
