"""Operators for text corpora: fingerprints, filters, joins, tokens, packing.

Each operator lives in a module of its own and takes and returns DataFrames;
:mod:`folioflow.llm.queries` registers one query per operator.  Nothing in
the rest of the library imports this subpackage.
"""
