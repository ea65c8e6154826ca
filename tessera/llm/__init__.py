"""Training-data operators: secrets, quality, fingerprints, extraction, language, dedup, shards, mixing, packing.

Every module keeps a general ``DataFrame -> DataFrame`` interface.  The thin
``opN_*`` queries over the synthetic tables live in :mod:`tessera.llm.queries`.
"""
