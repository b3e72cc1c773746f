"""Operators for training corpora: chats, duplicates, search, languages, quality, packing, pages and tokens."""
