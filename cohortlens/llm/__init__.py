"""Operators of a training-data pipeline, over a table of documents.

Nothing outside this subpackage imports it.  ``queries`` holds the registered
queries; every operator has a general interface of its own in its module.
"""
