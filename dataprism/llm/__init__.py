"""Training-data operators: deduplication, classifiers, decontamination, tokenisation, sharding and quality rules.

Nothing outside this package (and ``corpus_pipeline.py``) imports it. Every operator takes a DataFrame with at least
``doc_id`` and ``text`` (and ``source`` or ``n_chars`` where named) and ignores any other column.
"""
