"""Clustering, its scores, grids and automatic choice."""
