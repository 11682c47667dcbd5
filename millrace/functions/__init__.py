"""Column functions, all JVM-side."""
from millrace.functions.text import labelled, spaced

__all__ = ["labelled", "spaced"]
