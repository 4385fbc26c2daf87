"""Retail analytics over invoice lines, written as Spark DataFrame operators."""
