"""tagloom: molecular-tag (UMI) sequencing analytics and text preparation on Spark DataFrames."""
