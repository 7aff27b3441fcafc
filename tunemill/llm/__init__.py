"""Operators for preparing training data: archives, quality, token counts, URL rules, fingerprints, packing, languages."""
