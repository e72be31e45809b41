"""Composed plans: the reference's end-to-end table builds as single lazy
Spark plans over DataFrames."""
