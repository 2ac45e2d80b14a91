"""Training-data operators: dedup, packing, token counts, quality, decontamination, output, sharding, extraction, PII.

Nothing else in the package imports this folder.
"""
