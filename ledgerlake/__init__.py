"""Sales analytics on Spark: landed API pages in, typed entities, a sales fact and a metric layer out."""
