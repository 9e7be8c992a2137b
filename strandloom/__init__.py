"""A Spark-native engine for gene-neighbourhood analytics."""
