"""Sources: the test parquet tables and the domain tables derived from them."""
