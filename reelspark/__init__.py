"""reelspark: time-indexed multimodal analytics on Spark DataFrames."""
