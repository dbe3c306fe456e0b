"""Analytics for large tables of social-media posts, as lazy PySpark DataFrame operators."""
