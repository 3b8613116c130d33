"""Scaling, encoding, banding and text features."""
