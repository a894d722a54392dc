"""microlake: medallion-style analytics for coded administrative microdata, written as Spark DataFrame plans."""
