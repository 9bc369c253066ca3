"""demandkit: retail demand forecasting as composable Spark DataFrame operators."""
