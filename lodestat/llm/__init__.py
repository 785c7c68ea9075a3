"""Operators for preparing training data: text, vectors and packed token ids."""
