"""Operations of a training-data pipeline: tokens, deduplication, toxicity, HTML, licences, mixing."""
