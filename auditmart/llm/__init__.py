"""Operators for preparing training text: secret scans, packing, toxicity,
near-duplicate and substring dedup, token counts, URL filters, fingerprints and
decontamination.  Nothing outside this subpackage imports it."""
