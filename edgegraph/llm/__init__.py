"""Training-data operators: language ID, licence scans, quality rules, WARC, decontamination, URL filters,
line dedup, LM scoring, source mixing and near-duplicate detection.

One module per operator, each with its own general interface; :mod:`edgegraph.llm.queries` holds the thin
``opN_<name>`` queries. Nothing else in the library imports this subpackage.
"""
