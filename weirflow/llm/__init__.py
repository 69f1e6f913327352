"""Operators for text and typed records of training corpora; nothing else in the library imports them."""
