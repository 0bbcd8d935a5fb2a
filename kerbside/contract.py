"""The data contract: column types, allowed values, bounds and thresholds.

Everything below is a fixed value that results depend on.
"""

from pyspark.sql import types as T

# Raw record.
RAW_TYPES = {
    "violation_id": "string",
    "timestamp": "string",
    "violation_type": "string",
    "zone": "string",
    "speed_kmh": "double",
    "fine_amount": "double",
    "vehicle_type": "string",
    "officer_id": "string",
    "latitude": "double",
    "longitude": "double",
}
REQUIRED = ["violation_type", "zone", "timestamp"]

# Header spellings seen in the wild -> canonical column.
HEADER_ALIASES = {
    "speed": "speed_kmh",
    "Speed": "speed_kmh",
    "fine": "fine_amount",
    "Fine": "fine_amount",
    "type": "violation_type",
    "Type": "violation_type",
    "lat": "latitude",
    "lon": "longitude",
    "lng": "longitude",
    "officer": "officer_id",
    "vehicle": "vehicle_type",
    "id": "violation_id",
}

# Categories.
VIOLATION_TYPES = ["Speeding", "Red-Light", "DUI", "Illegal Park", "Reckless", "Mobile Use", "No Seatbelt"]
ZONES = ["Downtown", "Highway", "School Zone", "Residential", "Industrial"]
VEHICLES = ["Car", "Truck", "Motorcycle", "Bus", "Van"]
SEVERITIES = ["High", "Medium", "Low"]
UNKNOWN = "Unknown"
UNKNOWN_OFFICER = "UNKNOWN"
TYPE_SPELLINGS = {name.lower(): name for name in VIOLATION_TYPES}
ZONE_SPELLINGS = {name.lower(): name for name in ZONES} | {"school": "School Zone"}

# Standardised (zone, type) pairs: the size bound that makes broadcasting
# per-pair statistics safe.
MAX_ZONE_TYPE_GROUPS = (len(ZONES) + 1) * (len(VIOLATION_TYPES) + 1)

# Numeric domains.
BOUNDS = {
    "speed_kmh": (0.0, 200.0),
    "fine_amount": (0.0, 5000.0),
    "latitude": (-90.0, 90.0),
    "longitude": (-180.0, 180.0),
    "hour": (0.0, 23.0),
}
PEAK_HOURS = [(7, 9), (17, 19)]
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Severity and risk.
ALWAYS_HIGH = ["DUI", "Reckless", "Red-Light"]
ALWAYS_MEDIUM = "Mobile Use"
SPEEDING = "Speeding"
SPEEDING_MEDIUM = 15.0
SPEEDING_HIGH = 30.0
SEVERITY_WEIGHTS = {"High": 1.0, "Medium": 0.5, "Low": 0.1}
SEVERITY_CODES = {"Low": 0, "Medium": 1, "High": 2}
RISK_MIX = {"severity": 50.0, "speed": 30.0, "fine": 20.0}

# Fine by zone and severity, used by the generators.
FINES = {
    "Downtown": {"High": 500, "Medium": 250, "Low": 100},
    "Highway": {"High": 600, "Medium": 300, "Low": 150},
    "School Zone": {"High": 800, "Medium": 400, "Low": 200},
    "Residential": {"High": 350, "Medium": 175, "Low": 75},
    "Industrial": {"High": 400, "Medium": 200, "Low": 100},
}

# Buckets as (upper bound inclusive, label), then the label beyond.
SPEED_CATEGORIES = [(0.0, "stationary"), (15.0, "slow"), (40.0, "moderate"), (80.0, "fast")]
SPEED_BEYOND = "excessive"
FINE_TIERS = [(100.0, "low"), (300.0, "medium")]
FINE_BEYOND = "high"

# Data-quality thresholds.
COMPLETENESS = {
    "violation_type": 1.00,
    "zone": 1.00,
    "severity": 1.00,
    "fine_amount": 0.95,
    "timestamp": 0.99,
    "speed_kmh": 0.90,
}
RANGE_CHECKED = ["speed_kmh", "fine_amount", "latitude", "longitude", "hour"]
MAX_OUT_OF_BOUNDS = 0.01
MAX_BAD_SPEEDING = 0.02
MAX_LAG_DAYS = 7
GATE_SCORE = 90.0
MAX_FINE_NULL_PCT = 5.0
NON_NULLABLE = ["violation_type", "zone", "severity"]
REPORT_REQUIRED = ["violation_type", "zone", "severity", "fine_amount"]
ALLOWED = {
    "violation_type": VIOLATION_TYPES + [UNKNOWN],
    "zone": ZONES + [UNKNOWN],
    "severity": SEVERITIES,
}

# Streaming.
TOPIC = "traffic-violations"
ALERT_TOPIC = "traffic-alerts"
PARTITIONS = 5
ALERT_TYPES = ["DUI", "Reckless"]
ALERT_SPEED = 60.0
WATERMARK = "2 minutes"
WINDOW = "5 minutes"
SLIDE = "1 minute"

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("violation_type", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("fine_amount", T.DoubleType()),
    T.StructField("vehicle_plate", T.StringType()),
])

# The wording of the schema report, by rule. %d and %.1f are the figure of the finding.
SCHEMA_MESSAGES = {
    "required": "Missing required column: '{field}'",
    "nulls": "'{field}' has %d nulls",
    "bounds": "'{field}' has %d values outside [{low:g}, {high:g}]",
    "duplicates": "%d duplicate rows detected",
    "null_rate": "fine_amount null rate %.1f%% exceeds 5%% threshold",
    "allowed_set": "'%s' contains %d unexpected values",
}

# The wording of the quality report and of its alert.
REPORT_TITLE = "# Data Quality Report"
REPORT_RUN_AT = "**Run at:** "
REPORT_SCORE = "**Overall score:** %.1f%%  |  Passed: %d  |  Failed: %d"
REPORT_CHECKS = ["", "## Check Results", "| Dimension | Field | Status | Detail |", "|-----------|-------|--------|--------|"]
REPORT_CHECK = "| %s | %s | %s %s | %s |"
REPORT_ANOMALIES = ["", "## Anomaly Detection"]
REPORT_TOTAL = "**Total anomalies flagged:** %d"
REPORT_ANOMALY_HEAD = ["", "| violation_id | fine_amount | reason |", "|---|---|---|"]
REPORT_ICONS = {"PASS": "✓", "WARN": "⚠"}
REPORT_OTHER_ICON = "✗"
ALERT_MESSAGE = "DQ ALERT: score=%.1f%% - below {threshold:.0f}%% threshold"
