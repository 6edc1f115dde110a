"""Training-data operators: fingerprints, shards, mixtures, language, neighbours, joins, licences, tokens, toxicity."""
