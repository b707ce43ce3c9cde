"""Training-data operators: decontamination, extraction, counting, search,
formatting, personal data, near duplicates, licences, language and mixing.

Nothing else in the library imports this subpackage.
"""
