"""Specimen and observation analytics on PySpark, as DataFrame-to-DataFrame functions."""

__version__ = "0.1.0"
