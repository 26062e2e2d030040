"""Training-data operators: audit, deduplication, decontamination, quality and tokenizers.

Nothing else in the library imports this subpackage. Each module holds one operator with a
general interface; ``queries.py`` registers the contract queries over the given tables.
"""
