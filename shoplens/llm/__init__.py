"""Training-data operators: extraction, filtering, deduplication, packing.

Nothing outside this subpackage imports it.  ``queries`` holds the
registered ``opN_<name>`` queries over the driver's tables.
"""
