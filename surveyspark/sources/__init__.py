"""Reading and writing tables; stand-in survey views over the test tables."""
