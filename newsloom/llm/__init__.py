"""Training-data operators: near-duplicate joins, tokenizers, classifiers, search and filters.

Nothing else in the library imports this subpackage.
"""
