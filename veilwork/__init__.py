"""PySpark-native engine for building, querying and evaluating paired image-effect datasets."""
