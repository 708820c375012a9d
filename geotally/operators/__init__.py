"""Analyses over a messages DataFrame (typed as ``geotally.schema.MESSAGE_SCHEMA``)."""
