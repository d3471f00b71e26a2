"""Training-data operators: deduplication, decontamination, filters, scoring and mixing.

Each module holds one operator (its general interface) and the thin query
registered for it; ``catalogue.py`` gathers the queries.  Nothing outside this
subpackage imports it.
"""
