"""Parameter objects and fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values. Results must agree with these, so they are stated as they are.
# ---------------------------------------------------------------------------

# Requests per second allowed to each role, and to a role that is not listed.
ROLE_RATES = {
    "admin": 10000.0,
    "operator": 5000.0,
    "viewer": 1000.0,
    "service": 5000.0,
    "guest": 3000.0,
}
UNKNOWN_ROLE_RATE = 10.0

# Permission scopes and the default roles.
PERMISSIONS = [
    "metrics:read",
    "metrics:write",
    "scaling:read",
    "scaling:write",
    "scaling:execute",
    "predictions:read",
    "predictions:write",
    "config:read",
    "config:write",
    "config:admin",
    "user:read",
    "user:write",
    "user:admin",
    "logs:read",
    "logs:admin",
    "service:health",
    "service:shutdown",
]
ROLE_PERMISSIONS = {
    "admin": PERMISSIONS,
    "operator": [
        "metrics:read",
        "scaling:read",
        "scaling:write",
        "scaling:execute",
        "predictions:read",
        "service:health",
    ],
    "viewer": ["metrics:read", "scaling:read", "predictions:read", "service:health"],
    "service": [
        "metrics:read",
        "metrics:write",
        "scaling:read",
        "predictions:read",
        "predictions:write",
        "service:health",
    ],
    "guest": ["metrics:read", "service:health"],
}
ROLE_DESCRIPTIONS = {
    "admin": "Full system access",
    "operator": "Manage scaling and workloads",
    "viewer": "Read-only monitoring access",
    "service": "Service-to-service authentication",
    "guest": "Limited public read access",
}

# Upper bucket edges of the histograms, in seconds; +Inf is implied.
HISTOGRAM_EDGES = {
    "ingestion_latency_seconds": [0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0],
    "db_query_duration_seconds": [0.001, 0.01, 0.05, 0.1, 0.5, 1.0],
    "anomaly_detection_duration_seconds": [0.1, 0.5, 1.0, 2.0, 5.0],
    "scaling_decision_duration_seconds": [0.01, 0.1, 0.5, 1.0, 2.0],
    "http_request_duration_seconds": [0.001, 0.01, 0.05, 0.1, 0.25, 0.5, 1.0],
    "redis_operation_duration_seconds": [0.001, 0.01, 0.05, 0.1],
}

# Names of circuit states by gauge value.
CIRCUIT_STATES = {0: "CLOSED", 1: "HALF_OPEN", 2: "OPEN"}

# Words that decide the tone of a severity or status.
TONE_WORDS = {
    "bad": ["critical", "error", "high", "bad"],
    "warn": ["warning", "warn", "medium"],
    "good": ["ok", "healthy", "operational", "active", "resolved", "info", "low"],
}

# Lead-in of a rule anomaly text, by metric.
RULE_TEXT = {"cpu": "High CPU usage", "memory": "High Memory usage", "latency": "High Latency"}

# Alternative names accepted for the fields of an ingest request.
INGEST_ALIASES = {
    "cpu_usage": ["cpu_usage", "cpu"],
    "memory_usage": ["memory_usage", "memory"],
    "latency_ms": ["latency_ms", "latency"],
    "requests_per_sec": ["requests_per_sec", "rps"],
    "disk_usage": ["disk_usage", "disk"],
}
DEFAULT_NODE = "api-client"
DEFAULT_DISK = 0.0
BULK_MIN, BULK_MAX = 1, 1000

# Model names written with a forecast.
MODEL_SEASONAL = "prophet_lstm"
MODEL_ARIMA = "arima_fallback"
MODEL_EMA = "ema_fallback"
MODEL_NONE = "insufficient_data"

# Forecast gates and constants.
FULL_HISTORY_BUCKETS = 2016
ARIMA_MIN_BUCKETS = 8
DAY_BUCKETS = 288
EMA_ALPHA = 0.3
EMA_CONFIDENCE = 0.6
HORIZON_MINUTES = 10
HISTORY_MINUTES = 14 * 24 * 60

# Alert rules with a hold time: name, threshold, hold seconds.
HOLD_RULES = {
    "HighErrorRate": (0.05, 120),
    "HighLatency": (0.5, 300),
    "DBConnectionExhaustion": (40.0, 60),
    "MemoryLeak": (0.0, 900),
}

# Days each table is kept.
RETENTION_DAYS = {
    "metrics": 30,
    "anomalies": 90,
    "alerts": 60,
    "predictions": 7,
    "scaling_events": 90,
}

# Apdex limits in seconds.
APDEX_SATISFIED = 0.2
APDEX_TOLERABLE = 1.0


# ---------------------------------------------------------------------------
# Parameter objects
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Thresholds:
    """Limits of the rule detector."""

    cpu: float = 85.0
    memory: float = 90.0
    latency: float = 500.0

    def as_dict(self) -> dict[str, float]:
        return {"cpu": self.cpu, "memory": self.memory, "latency": self.latency}


PRODUCTION_THRESHOLDS = Thresholds(cpu=90.0, memory=92.0, latency=600.0)


@dataclass(frozen=True)
class Gains:
    """Controller gains and bounds; a negative action adds capacity."""

    kp: float = 1.0
    ki: float = 0.05
    kd: float = 0.5
    setpoint: float = 70.0
    action_min: float = -5.0
    action_max: float = 10.0
    integral_max: float = 100.0

    def tuned(self, kp: float, ki: float, kd: float) -> Gains:
        return replace(self, kp=kp, ki=ki, kd=kd)

    def clamped(self, low: float, high: float) -> Gains:
        return replace(self, action_min=low, action_max=high)


GAIN_PRESETS = {
    "default": Gains(),
    "aggressive": Gains(kp=2.0, ki=0.1, kd=1.0),
    "conservative": Gains(kp=0.5, ki=0.02, kd=0.2),
}


@dataclass(frozen=True)
class ScalerPolicy:
    """Everything a scaling decision depends on besides its inputs."""

    gains: Gains = field(default_factory=lambda: Gains(action_min=-3.0, action_max=3.0))
    headroom: float = 0.15
    spike_threshold: float = 0.6
    spike_boost: float = 1.5
    min_magnitude: float = 0.5
    min_interval_s: float = 15.0
    min_workers: int = 1
    max_workers: int = 8
    rps_per_worker: float = 300.0

    @property
    def headroom_limit(self) -> float:
        return self.gains.setpoint * (1 + self.headroom)


LIBRARY_POLICY = ScalerPolicy(gains=Gains(), min_interval_s=300.0)
