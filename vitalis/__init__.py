"""vitalis: vital-sign analytics on Spark (DataFrame / SQL / Structured Streaming)."""

__version__ = "0.1.0"
