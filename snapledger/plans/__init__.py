"""Configurations: the property domain, and inputs derived from the TPC-H-like testdata."""
