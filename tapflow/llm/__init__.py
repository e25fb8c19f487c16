"""Operations of a training-data pipeline: fingerprints, near copies, archives, filters, mixing, token files."""
