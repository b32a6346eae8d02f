"""Whole workloads, and the graph that the star-schema tables stand for."""
