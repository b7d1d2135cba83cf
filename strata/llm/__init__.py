"""Operators for preparing training text at scale, and the queries over them.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its
queries when the folder is present.
"""
