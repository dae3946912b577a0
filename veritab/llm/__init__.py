"""Training-data pipeline operators: repeated-text removal, near-duplicate joins, decontamination, quality
scoring, source mixing, sharding, chat formatting, URL filters, license scans and nearest neighbours."""
