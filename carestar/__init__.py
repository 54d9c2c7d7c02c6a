"""A Spark-native warehouse library: landing text -> typed staging -> star schema."""
