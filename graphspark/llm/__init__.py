"""Operators for building training corpora: filtering, fingerprints, de-duplication, mixing, packing.

Nothing else in the library imports this subpackage. Every operator takes DataFrames and returns a
DataFrame; ``queries`` registers one thin query per operator.
"""
