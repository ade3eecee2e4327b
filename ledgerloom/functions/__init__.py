"""Column helpers: parsing, exact money arithmetic and text normalisation."""
