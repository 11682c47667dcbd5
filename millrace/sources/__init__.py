"""Sources: where rows come from."""
from millrace.sources.sequence import sequence

__all__ = ["sequence"]
