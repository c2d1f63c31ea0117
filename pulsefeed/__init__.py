"""Privacy-aware personalization analytics expressed as Spark DataFrame plans."""
