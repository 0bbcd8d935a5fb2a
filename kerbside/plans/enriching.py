"""The enrichment plan: clean records -> scaled values and risk score."""

from pyspark.sql import DataFrame

from kerbside.operators import features


def enrich(clean: DataFrame, fine_spread=None) -> DataFrame:
    scaled = features.normalise_minmax(clean, {"speed_kmh": "speed_norm", "fine_amount": "fine_norm"})
    return features.add_risk_score(scaled, fine_spread)
