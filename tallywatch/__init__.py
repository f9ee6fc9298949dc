"""Payment-transaction monitoring on Spark: ledger, per-user metrics, alerts and live views."""
