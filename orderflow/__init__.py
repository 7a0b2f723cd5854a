"""Travel-order and user-behaviour analytics as plain PySpark DataFrame functions."""
