"""Training-data operators: language ID, near-duplicates, packing, PII, sharding, URL filters,
vector joins, WARC conversion, quality scoring and benchmark decontamination."""
