"""Readers, writers and the frame shapes the operators expect."""
