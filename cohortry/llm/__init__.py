"""Operators that prepare text, vectors and tokens for training."""
