"""Training-data operators: extraction, deduplication, decontamination,
quality rules, tokenisation, packing, language-model scoring, chat formatting.

Nothing else in the library imports this subpackage; it may be removed.
"""
