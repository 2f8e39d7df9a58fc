"""Training-data operators: language id, toxicity, mixing, archives, fingerprints,
decontamination, pseudonyms, near-duplicates, line dedup and token rollups.

One module per operator; ``catalogue`` registers one query for each.  Nothing
else in the library imports this subpackage.
"""
