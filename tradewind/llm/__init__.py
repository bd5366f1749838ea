"""Training-data operators: scans, counts, scores, deduplication, decontamination.

Nothing outside this subpackage imports it.
"""
