"""Operators over event rows, talk records and the property graph."""
