"""palmleaf: a Spark-native engine for building and analysing text corpora in complex scripts."""
