"""Business-register warehouse on Spark: type-2 versions, dimensions, integrity and analyses."""
