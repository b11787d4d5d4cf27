"""Operators for preparing training data: de-duplication, filters, tokens, archives."""
