"""Landing, staging and reporting of partner CSV drops on Spark DataFrames."""
