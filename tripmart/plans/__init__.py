"""The layers: bronze, staging, silver, gold, monitoring, and the job that runs them."""
