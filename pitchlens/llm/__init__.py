"""Operators of a training-data pipeline: sharding, quality rules, near and
exact deduplication, token counts, personal data, toxicity, chat formatting,
subword encoding and benchmark decontamination.

Each module holds one operator with its own general interface;
``queries.py`` derives the registered queries from them.  Nothing else in the
library imports this subpackage.
"""
