"""Operators for building language-model training data at scale.

One module per operator; ``queries`` holds the catalogue entries built from
them.  Nothing outside this package (and ``corpus_pipeline.py``, which counts
as part of it) imports it.

| module | operator |
| --- | --- |
| ``embedding_dedup`` | near-duplicate vectors by collision-counting projections |
| ``ngram_join`` | n-gram Jaccard join by PartEnum signatures |
| ``mixing`` | mixing sources to target weights by Sainte-Lague apportionment |
| ``line_dedup`` | line dedup by a log-template tree (SQL functions only) |
| ``url_filter`` | URL filter by a path-template tree |
| ``quality`` | quality score by regularised quadratic discriminant analysis |
| ``language_id`` | language identification by a byte convolutional network |
| ``packing`` | sequence packing by minimum bin slack |
| ``token_files`` | token ids in Parquet list columns, selective reads |
| ``ann`` | nearest neighbours by collision-counting hashing |
| ``whitening`` | embedding whitening by Chebyshev-filtered subspace iteration |
| ``hard_negatives`` | hard-negative mining by Strassen products and mergeable heaps |
| ``license_scan`` | license scan by ordered signature rules |
"""
