"""The row-local part of a run, applied to files as they arrive."""
