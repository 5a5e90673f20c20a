"""veristream: misinformation and scam analytics on PySpark."""

__version__ = "0.1.0"
