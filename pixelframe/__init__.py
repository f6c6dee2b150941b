"""pixelframe: land-cover mapping from multispectral rasters as Spark DataFrames."""
