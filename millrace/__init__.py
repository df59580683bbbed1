"""millrace: a DataFrame-native analytics engine on PySpark."""
