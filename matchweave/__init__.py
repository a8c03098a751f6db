"""Set-valued document matching and chat-history management on Spark DataFrames."""
