"""Operators for large text corpora: tokens, near and exact copies, personal data, secrets, quality, chat, packing."""
