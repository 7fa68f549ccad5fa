"""Physiological signal analytics expressed as Spark plans."""
