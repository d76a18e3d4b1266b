"""quarry: data-mining and recommender operators on Spark DataFrames."""

__version__ = "0.1.0"
