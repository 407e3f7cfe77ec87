"""Operators for preparing training text at scale.

One module per operator; nothing outside this package imports it.

  mixing          sources mixed to target weights (prefix sums over hash order)
  suffix_dedup    repeated byte strings across documents (external induced sorting)
  toxicity        convolutional text classifier
  exact_dedup     stateful streaming exact deduplication
  pii             keyed surrogates for personal data
  license_scan    canonical licence digests
  simhash         SimHash near duplicates by generalised pigeonhole
  packing         order-preserving packing by dynamic programming
  language_id     word-level language labels (linear-chain CRF)
  quality_rules   line-first cleaning
  embedding_dedup near-duplicate vectors (PCA-ordered tiled comparison)
  vector_codes    product codes, nearest entries by GNAT
  sphere_clusters centroid clusters with geometric drift bounds
  vectors         vector columns as matrices
  components      connected components of an edge table
  queries, sql    registered queries and their DuckDB SQL
"""
