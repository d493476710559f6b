"""caseledger: a PySpark-native analytics engine for case registers."""
