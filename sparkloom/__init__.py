"""sparkloom: a PySpark-native engine for preparing text and multimodal corpora."""
