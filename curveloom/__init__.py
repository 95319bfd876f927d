"""curveloom: a Spark-native engine for measurement curves and the documents around them."""
