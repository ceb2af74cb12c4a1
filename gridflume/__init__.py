"""gridflume: gridded-forcing and hydrologic-observation analytics on Spark."""
