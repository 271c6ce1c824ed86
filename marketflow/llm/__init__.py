"""Training-data operators: scanning, filtering, deduplicating, formatting and packing text.

Each module holds one operator with a general interface (any DataFrame with an id and a
text column); ``queries`` derives the registered queries from them.  Nothing outside this
subpackage imports it.
"""
