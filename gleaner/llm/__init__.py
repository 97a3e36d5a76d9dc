"""Training-data operators: dedup, quality, decontamination, tokens, packing.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries (one thin query per operator).
"""
