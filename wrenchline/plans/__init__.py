"""Whole jobs: the query catalogue, the report of a batch, the batch run."""
