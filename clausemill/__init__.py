"""clausemill: a Spark-native analytics engine for collections of standards and other long documents."""
