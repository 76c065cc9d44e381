"""Operators of a training-data pipeline: ten building blocks over ``documents``, ``embeddings`` and
``conversations``, each with a registered query in :mod:`tidemark.llm.registry`."""
