"""dqspark: data-quality operators (ingest, profile, clean, fuzzy dedupe,
validate) expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
