"""Operators of a training-data pipeline: packing, mixing, deduplication, language, token counts, filters and search.

Nothing outside this package imports it. Operators run jobs while they are being built only where their docstring
names the table they store; those tables lie below the folder that ``spark.checkpoint.dir`` names.
"""
