"""Operators for training-data corpora: filters, duplicate search, language and safety labels, packing."""
