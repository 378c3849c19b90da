"""Training-data pipeline operators (licence scans, dedup, URL rules, toxicity,
chat formatting, similarity joins, packing, quality models, BPE).

Nothing else in the library imports this subpackage. Each operator module has a
general interface on DataFrames; ``queries`` holds the thin registered queries.
"""
