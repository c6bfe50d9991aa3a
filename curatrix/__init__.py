"""curatrix: building and curating instruction-tuning datasets on Spark DataFrames."""

__version__ = "0.1.0"
