"""tidemart: warehouse table maintenance and analytic pipelines as PySpark DataFrame functions."""
