"""tessera: a PySpark-native engine for catalogues of sparse, spatial sample data."""
