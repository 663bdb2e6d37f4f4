"""Training-data operators: extraction, search, quality, deduplication, mixing, tokenisation.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its queries when it is present.
"""
