"""A PySpark-native engine for collections of exam papers and text corpora."""
