"""wardflow: hospital-warehouse analytics written as Spark DataFrame plans."""
