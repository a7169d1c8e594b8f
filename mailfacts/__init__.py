"""Email-marketing facts and dimensions as Spark DataFrame plans."""
