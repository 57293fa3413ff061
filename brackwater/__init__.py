"""Spark-native analytics for coastal imagery, salinity casts and the corpora around them."""
