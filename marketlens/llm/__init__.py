"""Training-data operators on Spark: token counts, licence scans, quality rules,
substring and near-duplicate removal, web archives, language ids, packing,
benchmark decontamination, whitening of embeddings, spelling variants and byte-pair
encoding. Nothing else in the library imports this package."""
