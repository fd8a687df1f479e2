"""Training-data operators: packing, quality, language, archives, joins, tokens, embeddings, chat.

Each module holds one operator as functions from DataFrames to a DataFrame; ``queries`` registers
one query per operator over the whole driver tables. Nothing else in the library imports this.
"""
