"""Importing this module registers all queries of the engine."""

from curveloom.plans import calibration_queries, curve_queries, document_queries, output_queries, signal_queries, text_queries  # noqa: F401
