"""Topic names of the pipeline."""

# Topic names.
BRONZE = "logs.bronze.events.v1"
SILVER = "logs.silver.events.v1"
GOLD = "logs.gold.assessed-events.v1"
DEAD_PARSE = "logs.dead.parse-errors.v1"
DEAD_CLEAN = "logs.dead.clean-errors.v1"
DEAD_ENRICH = "logs.dead.enrich-errors.v1"
WINDOWED = "logs.aggregated.windowed-events.v1"
CORRELATED = "logs.aggregated.correlated-events.v1"
BASELINE = "logs.aggregated.baseline-alerts.v1"

FINDINGS = (WINDOWED, CORRELATED, BASELINE)
