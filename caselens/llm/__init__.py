"""Operators for preparing training text: de-duplication, filters, tokens, packing, archives."""
