"""Operators of a large training-data pipeline (see ``queries.py``)."""
