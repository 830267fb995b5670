"""Post analytics on Spark: shaping, text preparation, annotation and marts."""
