"""Training-data operators: PII, near duplicates, chat formatting, packing, filters, scans.

Nothing else in the library imports this subpackage.
"""
