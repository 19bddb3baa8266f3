"""strandloom: coordinate-keyed (interval, sequence, alignment) analytics as PySpark plans."""
