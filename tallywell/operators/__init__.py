"""Jobs over survey tables: DataFrame in, DataFrame out."""
