"""The time joins and windows over streams of rows."""
