"""Client segmentation and targeted offers as composable Spark DataFrame operators."""
