"""tidemark: e-commerce source data to tested marts, as Spark jobs."""

__version__ = "0.1.0"
