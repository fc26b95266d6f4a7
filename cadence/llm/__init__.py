"""Operators for large-scale training-data pipelines, on Spark.

Nothing else in the library imports this subpackage; ``queries`` holds the
registered queries and their SQL, and every other module one operator:

1  line_runs         line dedup by levelled sorted runs of line hashes
2  chat_format       chat formatting chosen by schema fingerprints
3  subword_quality   supervised subword embeddings for quality
4  complement_pack   best-fit packing by exact-complement hashing
5  license_rules     licence recognition by sentence rules
6  hamming_dedup     MinHash near-dedup by a multi-index Hamming join
7  voronoi_topk      exact top-k by a Voronoi kNN join
8  byte_bpe          byte-level BPE encoding and decoding
9  toxic_grammar     toxicity by a weighted finite-state pattern grammar
10 learned_partitions  approximate nearest neighbours by learned partitions
11 spelling_variants  spelling variants by dynamic programming over sorted lists
12 chunk_collocations  phrase collocations by prefix-free parsing
13 rank_bpe          BPE encoding and decoding by contiguous rank arrays
"""
