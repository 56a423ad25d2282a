"""Reading and writing corpora, packed tables and vocabularies."""
