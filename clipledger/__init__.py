"""Creator-video and comment analytics as Spark jobs over landed JSON pages and two tables."""
