"""Evidence-mining analytics on Spark: DataFrame-to-DataFrame operators, sources, sinks and plans."""
