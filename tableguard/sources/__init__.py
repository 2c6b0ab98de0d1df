"""Readers for the tables the operators consume."""
