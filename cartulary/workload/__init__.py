"""The queries over the driver tables and the corpus rendered from them."""
