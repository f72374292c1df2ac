"""Document-dataflow engine on Spark: pages, lines, parts, questions, datasets."""

__version__ = "0.1.0"
