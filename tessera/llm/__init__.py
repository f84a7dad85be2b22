"""Training-data operators: mixing, quality rules, URL filters, deduplication, sharding, formats, tokens.

Nothing else in the library imports this subpackage; it uses the general
helpers of :mod:`tessera.session`.
"""
