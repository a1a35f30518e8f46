"""Operators a training-data pipeline needs, on whole tables of documents, pages and vectors.

Nothing outside this subpackage imports it; ``queries`` registers one query per operator.
Operators that run Python inside tasks need the package installed on the executors.
"""
