"""Care analytics on Spark: landing files -> typed tables -> star schema -> measures."""
