"""Operators for training-data pipelines over very large corpora.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds the
queries of :mod:`modenorm.llm.queries` when the folder is present.
"""
