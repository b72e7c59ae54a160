"""catloom: catalogue reconciliation and data-preparation operators for PySpark DataFrames."""
