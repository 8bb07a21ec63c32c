"""Training-data operators: fixity audit, toxicity, tokenizing, language
identification, near and exact deduplication, LM scoring, packing, vector
codes, periodic runs and secret scans.

Nothing else in the library imports this subpackage.
"""
