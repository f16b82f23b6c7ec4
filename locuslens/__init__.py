"""Spark-first analytics for genome-editing safety data, plus corpus operators in ``locuslens.llm``."""
