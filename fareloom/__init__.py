"""fareloom: trip analytics and fare modelling as Spark DataFrame operators."""

__version__ = "0.1.0"
