"""panelkit: survey-panel analytics on Spark (DataFrame / SQL / Spark ML)."""
