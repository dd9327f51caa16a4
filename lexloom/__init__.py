"""Text-corpus and lexicon analytics on Spark DataFrames."""
