"""Operators that prepare training data for language models.

Nothing else in the library imports this subpackage; ``queries`` registers its
queries.  Operators marked *native* use column expressions only; the others run
Arrow batches through Python where Spark has no such function.
"""
