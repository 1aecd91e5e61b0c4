"""Training-data operators: tokens, language models, deduplication, cleaning.

Each module holds one operator with its own general interface; ``queries``
holds the thin registered queries over the ``documents`` table.
"""
