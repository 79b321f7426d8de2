"""Evidence-backed record keeping on Spark: rules, evidence fusion and corpus mining as DataFrame plans."""
