"""strata: a Spark-native engine for building and querying a lake of public earth-science records."""
