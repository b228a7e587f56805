"""Whole flows from source records to reports, and the catalogue of queries over them."""
