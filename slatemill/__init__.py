"""slatemill: a PySpark-native engine for governing teaching-document content as data."""
