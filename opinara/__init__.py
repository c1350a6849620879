"""Opinion analytics and data-quality measures over short public texts, on Spark."""
