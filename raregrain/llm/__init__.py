"""Operators of a training-data pipeline: dedup, fingerprints, packing, language id, tokens, chat, licences."""
