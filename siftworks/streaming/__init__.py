"""The same cleaning on files as they arrive."""
