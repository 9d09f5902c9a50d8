"""docloom: a PySpark-native engine for document evidence, versions and corpora."""
