"""Event-stream and table analytics expressed as plain PySpark DataFrame functions."""
