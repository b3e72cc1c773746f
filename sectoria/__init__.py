"""Sectoria: territorial, climate and survey analytics as PySpark DataFrame operators."""
