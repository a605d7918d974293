"""Training-data operators: tokenizing, extraction, near and substring
duplicates, mixing, search, language ID, chat formatting.

Nothing outside this folder imports it, except ``__spark_entry__`` (guarded)
and ``corpus_pipeline``.
"""
