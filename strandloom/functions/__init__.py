"""Part of strandloom; see the package docstring."""
