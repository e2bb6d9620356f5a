"""Reports over the marts and the end-to-end run."""
