"""Preparing texts for training language models; nothing else in the library uses this."""
