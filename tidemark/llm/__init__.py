"""Operators for preparing training data: filters, deduplication, tokenizing, packing and archives."""
