"""strandloom: a PySpark-native engine for tables, genomic intervals and the statistics built on them."""
