"""Operators for preparing training data for language models.

Nothing outside this folder imports it; ``queries.py`` holds the registry that
``__spark_entry__.py`` adds when the folder is there.
"""
