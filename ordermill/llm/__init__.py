"""Training-data operators (near and exact dedup, language ID, license
scan, decontamination, LM scoring, HTML extraction, packing, toxicity).

Nothing else in the library imports this subpackage. Shared rules of all
operators: only the columns an operator names are read (extra columns
cannot clash with its own), a null text counts as empty unless the
operator says otherwise, repeated rows are treated row by row, and an
empty table gives an empty result of the same schema.
"""
