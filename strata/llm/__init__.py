"""Operators of a training-data pipeline: language, personal data, quality, duplicates,
toxicity, licences, mixing and packing. Nothing else in the library imports this folder."""
