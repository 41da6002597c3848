"""citelake: bibliographic works analytics on Spark DataFrames."""
