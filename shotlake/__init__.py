"""A lake of spaceborne lidar footprints on Spark: build, maintain, query."""
