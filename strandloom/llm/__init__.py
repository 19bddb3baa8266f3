"""Training-data operators: near-dedup, mixing, LM scoring, token counts, WARC, quality, BPE, line dedup, top-k, substring dedup.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
