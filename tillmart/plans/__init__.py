"""Whole plans: the star schema, the analytical views, the batch run."""
