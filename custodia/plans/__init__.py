"""Whole jobs: ingest, warehouse load, marts, reports and chart feeds."""
