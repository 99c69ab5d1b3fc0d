"""Error-log classification and reporting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import contains_any, lookup

# Fixed classification rules: error type -> severity, category, recovery.
RULES = {
    "NoSuchBucket": ("high", "data_access", "escalate"),
    "NoSuchKey": ("medium", "data_access", "retry_with_backoff"),
    "AccessDenied": ("high", "configuration", "escalate"),
    "TimeoutError": ("medium", "processing", "retry_with_backoff"),
    "MemoryError": ("high", "resource", "degrade_gracefully"),
    "ConnectionError": ("medium", "external_service", "circuit_break"),
    "MlflowException": ("medium", "external_service", "retry_with_backoff"),
    "RestException": ("medium", "external_service", "circuit_break"),
    "BotoCoreError": ("high", "infrastructure", "retry_with_backoff"),
    "EndpointConnectionError": ("high", "infrastructure", "circuit_break"),
    "ValueError": ("low", "validation", "fail_fast"),
    "KeyError": ("low", "validation", "fail_fast"),
}
DEFAULT_RULE = ("medium", "unknown", "retry_with_backoff")

# Fixed keyword groups, checked in this order; the first group that matches acts.
CRITICAL_WORDS = ("critical", "fatal", "emergency")
RESOURCE_WORDS = ("memory", "disk", "timeout", "quota")
CONFIGURATION_WORDS = ("config", "permission", "auth", "credential")

# Fixed advice texts per error type.
ADVICE = {
    "NoSuchBucket": "Verify S3 bucket name and AWS credentials. Check bucket exists and is accessible.",
    "NoSuchKey": "Verify S3 object key exists. Check data pipeline has created expected files.",
    "AccessDenied": "Check IAM permissions for S3/MLflow access. Verify role policies are correct.",
    "TimeoutError": "Check network connectivity and service availability. Consider increasing timeout values.",
    "MemoryError": "Reduce batch size or enable data streaming. Monitor memory usage and consider scaling up.",
    "MlflowException": "Check MLflow server connectivity and status. Verify tracking URI configuration.",
}
CONNECTION_ADVICE = (
    "Check network connectivity to external services. Verify firewall and security group settings."
)
DEFAULT_ADVICE = "Review error details and context. Consider retry if error is transient."


def classify_errors(
    errors: DataFrame, error_type: str = "error_type", message: str = "message"
) -> DataFrame:
    """Add ``severity``, ``category``, ``recovery`` and ``advice``."""
    kind, text = F.col(error_type), F.col(message)

    def rule(i: int) -> Column:
        return lookup(kind, {name: r[i] for name, r in RULES.items()}, DEFAULT_RULE[i])

    critical = contains_any(text, CRITICAL_WORDS)
    resource = ~critical & contains_any(text, RESOURCE_WORDS)
    configuration = ~critical & ~resource & contains_any(text, CONFIGURATION_WORDS)
    based = errors.select(
        "*", rule(0).alias("_severity"), rule(1).alias("_category"), rule(2).alias("_recovery"),
        F.coalesce(critical, F.lit(False)).alias("_critical"),
        F.coalesce(resource, F.lit(False)).alias("_resource"),
        F.coalesce(configuration, F.lit(False)).alias("_configuration"),
    )
    severity = (
        F.when(F.col("_critical"), "critical")
        .when(F.col("_resource") & (F.col("_severity") == "low"), "medium")
        .otherwise(F.col("_severity"))
    )
    category = (
        F.when(F.col("_resource") & (F.col("_category") == "unknown"), "resource")
        .when(F.col("_configuration"), "configuration")
        .otherwise(F.col("_category"))
    )
    recovery = F.when(F.col("_critical") | F.col("_configuration"), "escalate").otherwise(
        F.col("_recovery")
    )
    advice = F.coalesce(
        lookup(kind, ADVICE),
        F.when(F.lower(text).contains("connection"), F.lit(CONNECTION_ADVICE)),
        F.lit(DEFAULT_ADVICE),
    )
    return based.select(
        *errors.columns, severity.alias("severity"), category.alias("category"),
        recovery.alias("recovery"), advice.alias("advice"),
    )


def recent(errors: DataFrame, until: Column, hours: int = 24, ts: str = "ts") -> DataFrame:
    """Errors strictly within ``hours`` before ``until``."""
    return errors.where(F.col(ts) > until - F.expr(f"INTERVAL {hours} HOURS"))


def error_report(classified: DataFrame, message: str = "message") -> DataFrame:
    """Counts by severity, category, component and message, plus the total.

    One pass with grouping sets: ``(dimension, key, n)``.
    """
    ready = classified.select(
        "severity", "category", "component", F.col(message).alias("message")
    )
    grouped = ready.groupingSets(
        [["severity"], ["category"], ["component"], ["message"], []],
        "severity", "category", "component", "message",
    ).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_set"))
    dimension = lookup(
        F.col("_set").cast("int"),
        {7: "severity", 11: "category", 13: "component", 14: "message", 15: "total"},
    )
    return grouped.select(
        dimension.alias("dimension"),
        F.coalesce("severity", "category", "component", "message", F.lit("all")).alias("key"),
        "n",
    )


def first_severe(classified: DataFrame, limit: int, ts: str = "ts", key: str = "error_id"):
    """The first HIGH/CRITICAL errors in time order."""
    return (
        classified.where(F.col("severity").isin("high", "critical")).orderBy(ts, key).limit(limit)
    )


def component_health(checks: DataFrame) -> DataFrame:
    """Latest status per component, and whether everything is healthy."""
    latest = checks.groupBy("component").agg(
        F.max_by("status", "ts").alias("status"),
        F.max_by("response_time_ms", "ts").alias("response_time_ms"),
        F.max("ts").alias("last_check"),
    )
    return latest


def overall_health(latest: DataFrame) -> DataFrame:
    return latest.agg(
        F.count(F.lit(1)).alias("components"),
        F.when(F.bool_and(F.col("status") == "healthy"), "healthy").otherwise("degraded")
        .alias("overall"),
    )
