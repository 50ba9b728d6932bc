"""framespool: time-synchronised sensor episodes and training-data work as Spark DataFrame operators."""
