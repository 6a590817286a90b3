"""Data-modelling and warehouse-loading operators over PySpark DataFrames and streams."""
