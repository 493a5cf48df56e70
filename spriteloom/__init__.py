"""Curation of sprite image datasets, and vector quantization, as Spark jobs."""
