"""Derived tables, data requests and analyses, composed from the operators."""
