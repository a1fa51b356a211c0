"""Training-data operators: tokens, packing, quality, archives, decontamination, language, licences, privacy, near duplicates.

Nothing else in the library imports this subpackage.
"""
