"""Data-quality checks, schema report, score, gate and report text.

Every per-column measure comes from one wide aggregate over one scan; only
the duplicate counts need a shuffle, and that carries keys or hashes alone.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from kerbside import contract as C
from kerbside.functions import columns as X
from kerbside.functions.ordered import attach

CHECK_FIELDS = ["dimension", "field", "status", "metric", "threshold", "detail"]


def _rate(flag):
    """Share of rows where the 0/1 flag is set; null on an empty input."""
    return F.avg(flag.cast("double"))


def duplicate_count(df: DataFrame, columns, name) -> DataFrame:
    """Second and later occurrences of a key, nulls equal, as one row."""
    groups = df.groupBy(*columns).agg(F.count("*").alias("__n"))
    return groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias(name))


def row_hashes(columns):
    """Two independent 64-bit hashes of a row; null is unlike any value."""
    parts = [e for c in columns for e in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def duplicate_rows(df: DataFrame, name, hashes=None) -> DataFrame:
    """Second and later occurrences of whole rows, nulls equal, as one row.

    Rows are folded by one hash, with the range of the other beside it, so 32
    bytes per distinct row are shuffled, whatever its width. Where rows of one
    hash differ in the other, the hash says nothing: only the rows of such
    groups are compared as they are.
    """
    first, second = hashes or row_hashes(df.columns)
    groups = df.select(first.alias("__a"), second.alias("__b")).groupBy("__a").agg(
        F.count("*").alias("n"), F.min("__b").alias("low"), F.max("__b").alias("high"))
    apart = F.col("low") != F.col("high")
    found, open_groups = groups.agg(F.coalesce(F.sum(F.when(~apart, F.col("n") - 1)), F.lit(0)), F.count_if(apart)).first()
    if not open_groups:
        return df.sparkSession.range(1).select(F.lit(found).cast("long").alias(name))
    colliding = attach(df.withColumn("__a", first), groups.where(apart).select("__a"), ["__a"], rows=open_groups)
    return duplicate_count(colliding, df.columns, "__more").select((F.lit(found) + F.col("__more")).cast("long").alias(name))


def _check(seq, dimension, field, metric, threshold, ok, detail, miss="FAIL"):
    return F.struct(
        F.lit(seq).alias("seq"),
        F.lit(dimension).alias("dimension"),
        F.lit(field).alias("field"),
        F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise(miss).alias("status"),
        metric.cast("double").alias("metric"),
        F.lit(threshold).cast("double").alias("threshold"),
        detail.alias("detail"),
    )


def dq_checks(df: DataFrame, as_of, completeness=None, ranged=None, freshness=True) -> DataFrame:
    """One row per check over five dimensions: completeness, validity,
    uniqueness, consistency, freshness.

    ``completeness`` and ``ranged`` choose the columns, so the smaller suite of
    the dashboard is the same function with fewer columns.
    """
    completeness = C.COMPLETENESS if completeness is None else completeness
    ranged = C.RANGE_CHECKED if ranged is None else ranged
    have = set(df.columns)
    aggs, checks = [F.count("*").alias("rows")], []

    def measure(expr):
        aggs.append(expr.alias(f"m{len(aggs)}"))
        return F.col(f"m{len(aggs) - 1}")

    # The wording of the details below.
    for field, need in completeness.items():
        if field not in have:
            absent = F.lit(None).cast("double")
            checks.append(_check(len(checks), "completeness", field, absent, need, F.lit(False),
                                 F.lit("column absent"), miss="SKIP"))
            continue
        rate = 1 - measure(_rate(F.col(field).isNull()))
        checks.append(_check(
            len(checks), "completeness", field, rate, need, rate >= need,
            F.format_string(f"%.1f%% complete (need ≥{need * 100:.0f}%%)", rate * 100)))
    for field in ranged:
        if field not in have:
            continue
        rate = measure(_rate(X.outside(X.number(F.col(field)), *C.BOUNDS[field])))
        checks.append(_check(
            len(checks), "validity", field, rate, C.MAX_OUT_OF_BOUNDS, rate < C.MAX_OUT_OF_BOUNDS,
            F.format_string("%.2f%% out-of-bounds (threshold: 1%%)", rate * 100)))
    if "violation_id" in have:
        rate = F.try_divide(F.col("dups").cast("double"), F.col("rows"))
        checks.append(_check(
            len(checks), "uniqueness", "violation_id", rate, 0.0, rate == 0,
            F.format_string("%.3f%% duplicate IDs", rate * 100)))
    if {"speed_kmh", "violation_type"} <= have:
        slow = F.coalesce(F.col("speed_kmh") <= 0, F.lit(False))
        rate = F.coalesce(measure(_rate(F.when(F.col("violation_type") == C.SPEEDING, slow))), F.lit(0.0))
        checks.append(_check(
            len(checks), "consistency", "speed_kmh/violation_type", rate, C.MAX_BAD_SPEEDING,
            rate < C.MAX_BAD_SPEEDING,
            F.format_string("%.1f%% 'Speeding' records with speed ≤ 0", rate * 100)))
    if freshness and "timestamp" in have:
        newest = measure(F.max(X.moment(F.col("timestamp"))))
        days = F.floor((F.lit(as_of).cast("timestamp").cast("double") - newest.cast("double")) / 86400)
        fresh = _check(
            len(checks), "freshness", "timestamp", days, C.MAX_LAG_DAYS, days <= C.MAX_LAG_DAYS,
            F.format_string("Most recent record is %d days old (threshold: 7 days)", days), miss="WARN")
        checks.append(F.when(newest.isNotNull(), fresh))

    wide = df.agg(*aggs)
    if "violation_id" in have:
        wide = wide.crossJoin(F.broadcast(duplicate_count(df, ["violation_id"], "dups")))
    rows = wide.select(F.explode(F.array_compact(F.array(*checks))).alias("c"))
    return rows.select("c.seq", *[f"c.{name}" for name in CHECK_FIELDS])


def dq_score(checks: DataFrame, run_at="") -> DataFrame:
    """Score, verdict and counts as one row. A stale input warns but counts
    as failed; skipped checks do not count."""
    good = F.count_if(F.col("status") == "PASS")
    bad = F.count_if(F.col("status").isin("FAIL", "WARN"))
    return checks.agg(
        F.coalesce(X.rounded(F.try_divide(good * 100.0, good + bad), 1), F.lit(0.0)).alias("score"),
        (bad == 0).alias("passed"),
        good.alias("n_pass"),
        bad.alias("n_fail"),
        F.lit(run_at).alias("run_at"),
    )


def unexpected_values(df: DataFrame, allowed=None) -> DataFrame:
    """Values outside the allowed sets, with their counts: (field, value, n)."""
    allowed = C.ALLOWED if allowed is None else allowed
    hits = [
        F.when(F.col(c).isNotNull() & ~F.col(c).isin(values),
               F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")))
        for c, values in allowed.items() if c in df.columns
    ]
    if not hits:
        return df.sparkSession.createDataFrame([], "field string, value string, n long")
    # One scan for all columns; rows without a hit vanish in the explode.
    return df.select(F.explode(F.array_compact(F.array(*hits))).alias("h")).groupBy(
        F.col("h.field").alias("field"), F.col("h.value").alias("value")).agg(F.count("*").alias("n"))


def schema_report(df: DataFrame) -> DataFrame:
    """Contract breaches only, as rows (level, rule, field, n, message)."""
    have = set(df.columns)
    aggs, findings, say = [F.count("*").alias("rows")], [], C.SCHEMA_MESSAGES

    def finding(level, rule, field, n, fired, message):
        row = F.struct(
            F.lit(level).alias("level"), F.lit(rule).alias("rule"), F.lit(field).alias("field"),
            n.cast("double").alias("n"), message.alias("message"))
        findings.append(F.when(fired, row))

    for c in C.REPORT_REQUIRED:
        if c not in have:
            finding("error", "required", c, F.lit(1), F.lit(True), F.lit(say["required"].format(field=c)))
    for c in C.NON_NULLABLE:
        if c in have:
            aggs.append(F.count_if(F.col(c).isNull()).alias(f"null_{c}"))
            n = F.col(f"null_{c}")
            finding("warning", "nulls", c, n, n > 0, F.format_string(say["nulls"].format(field=c), n))
    for c in ("speed_kmh", "fine_amount", "latitude", "longitude"):
        if c in have:
            low, high = C.BOUNDS[c]
            aggs.append(F.coalesce(F.sum(X.outside(X.number(F.col(c)), low, high)), F.lit(0)).alias(f"out_{c}"))
            n = F.col(f"out_{c}")
            finding("error", "bounds", c, n, n > 0,
                    F.format_string(say["bounds"].format(field=c, low=low, high=high), n))
    n = F.col("dup_rows")
    finding("warning", "duplicates", "*", n, n > 0, F.format_string(say["duplicates"], n))
    if "fine_amount" in have:
        aggs.append(_rate(F.col("fine_amount").isNull()).alias("fine_null"))
        pct = F.col("fine_null") * 100
        finding("error", "null_rate", "fine_amount", pct, pct > C.MAX_FINE_NULL_PCT,
                F.format_string(say["null_rate"], pct))

    wide = df.agg(*aggs).crossJoin(F.broadcast(duplicate_rows(df, "dup_rows")))
    fired = wide.select(F.explode(F.array_compact(F.array(*findings))).alias("f")).select("f.*")
    sets = unexpected_values(df).groupBy("field").agg(F.count("*").alias("k")).select(
        F.lit("warning").alias("level"), F.lit("allowed_set").alias("rule"), "field",
        F.col("k").cast("double").alias("n"),
        F.format_string(say["allowed_set"], "field", "k").alias("message"))
    return fired.unionByName(sets)


def schema_score(df: DataFrame) -> DataFrame:
    """Summary of the schema report as one row."""
    errors = F.count_if(F.col("level") == "error")
    warnings = F.count_if(F.col("level") == "warning")
    verdict = schema_report(df).agg(
        (errors == 0).alias("passed"),
        F.greatest(F.lit(0.0), F.lit(100.0) - errors * 10 - warnings * 2).cast("double").alias("score"),
        errors.alias("errors"),
        warnings.alias("warnings"),
    )
    size = df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).alias("cols"))
    return verdict.crossJoin(size)


def gate(df: DataFrame, score: DataFrame, threshold=C.GATE_SCORE):
    """Split a load by its quality score.

    Returns ``(accepted, quarantined, alert)``: accepted rows if the score
    reaches the threshold, rows that break a row rule, and one alert row if
    the score is too low.
    """
    judged = df.withColumn("gate_reason", row_faults(df)).crossJoin(
        F.broadcast(score.select(F.col("score").alias("__score"))))
    accepted = judged.filter((F.col("__score") >= threshold) & F.col("gate_reason").isNull()).drop(
        "__score", "gate_reason")
    quarantined = judged.filter(F.col("gate_reason").isNotNull()).drop("__score")
    alert = score.filter(F.col("score") < threshold).select(
        F.format_string(C.ALERT_MESSAGE.format(threshold=threshold), "score").alias("message"),
        "score")
    return accepted, quarantined, alert


def gate_counts(df: DataFrame, score: DataFrame, threshold=C.GATE_SCORE) -> DataFrame:
    """What :func:`gate` would route where, as rows (route, rows), in one pass over the load."""
    bad = row_faults(df).isNotNull()
    sizes = df.agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
    judged = sizes.crossJoin(F.broadcast(score.select((F.col("score") >= threshold).alias("open"))))
    routes = {"accepted": F.when(F.col("open"), F.col("good")).otherwise(0), "quarantined": F.col("bad"), "alerts": F.when(F.col("open"), 0).otherwise(1)}
    return judged.select(F.inline(F.array(*[F.struct(F.lit(name).alias("route"), n.cast("long").alias("rows")) for name, n in routes.items()])))


def row_faults(df: DataFrame):
    """The first row rule that a row breaks, or null."""
    rules = None
    for c in C.REQUIRED:
        if c in df.columns:
            test = F.col(c).isNull()
            text = f"{c} missing"
            rules = F.when(test, text) if rules is None else rules.when(test, text)
    for c in ("speed_kmh", "fine_amount", "latitude", "longitude"):
        if c in df.columns:
            test = X.outside(X.number(F.col(c)), *C.BOUNDS[c]) == 1
            text = f"{c} out of bounds"
            rules = F.when(test, text) if rules is None else rules.when(test, text)
    return F.lit(None).cast("string") if rules is None else rules


def report_lines(checks: DataFrame, score: DataFrame, anomalies: DataFrame, top=10) -> DataFrame:
    """The quality report as numbered markdown lines.

    The first ``top`` anomalies in id order are listed; the count covers all.
    """
    lines = lambda texts: [F.lit(t) for t in texts]
    icon = X.lookup(F.col("status"), C.REPORT_ICONS, C.REPORT_OTHER_ICON)
    head = score.select(F.posexplode(F.array(
        F.lit(C.REPORT_TITLE), F.concat(F.lit(C.REPORT_RUN_AT), F.col("run_at")),
        F.format_string(C.REPORT_SCORE, "score", "n_pass", "n_fail"), *lines(C.REPORT_CHECKS))).alias("line_no", "text"))
    body = checks.select(
        (F.lit(100) + F.col("seq")).alias("line_no"),
        F.format_string(C.REPORT_CHECK, "dimension", "field", icon, "status", "detail").alias("text"))
    total = anomalies.agg(F.count("*").alias("n"))
    listed = F.when(F.col("n") > 0, F.array(*lines(C.REPORT_ANOMALY_HEAD))).otherwise(F.array().cast("array<string>"))
    found = F.array(*lines(C.REPORT_ANOMALIES), F.format_string(C.REPORT_TOTAL, "n"))
    middle = total.select(F.posexplode(F.concat(found, listed)).alias("at", "text")).select((F.lit(1000) + F.col("at")).alias("line_no"), "text")
    first = anomalies.orderBy("violation_id").limit(top)
    numbered = first.agg(F.sort_array(F.collect_list(F.struct("violation_id", "fine_amount", "anomaly_reason"))).alias("a"))
    tail = numbered.select(F.posexplode("a").alias("at", "r")).select(
        (F.lit(2000) + F.col("at")).alias("line_no"),
        F.concat(
            F.lit("| "), F.coalesce(F.col("r.violation_id"), F.lit("N/A")),
            F.lit(" | "), F.coalesce(F.format_string("%.1f", F.col("r.fine_amount")), F.lit("N/A")),
            F.lit(" | "), F.trim("r.anomaly_reason"), F.lit(" |")).alias("text"))
    return reduce(DataFrame.unionByName, [
        part.select(F.col("line_no").cast("int"), "text") for part in (head, body, middle, tail)])


def run_summary(score: DataFrame, raw_rows: int, clean_rows: int, anomalies: int) -> DataFrame:
    """Rows in and out, drop rate, score and anomaly count as one row, from the row counts of the run's own writes."""
    drop = (1 - F.lit(clean_rows) / F.greatest(F.lit(raw_rows), F.lit(1))) * 100
    count = lambda n: F.lit(n).cast("long")
    return score.select(count(raw_rows).alias("raw_rows"), count(clean_rows).alias("clean_rows"), X.rounded(drop, 1).alias("drop_pct"),
                        F.col("score").alias("dq_score"), count(anomalies).alias("anomalies"))
