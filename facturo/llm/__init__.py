"""Training-data operators: token files, licence scan, dedup, language ID, WARC,
decontamination, near-dedup, URL filter, packing and personal-data extraction.

Nothing else in the library imports this subpackage.
"""
