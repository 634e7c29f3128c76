"""Alert rules: a small table of typed columns plus a map of parameters."""

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

RULE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("enabled", T.BooleanType()), T.StructField("severity", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
])

# Accepted rule types and the parameters each needs.
TAG_TYPES = ["tag_route", "tagged_route", "tag_routing"]
REQUIRED_PARAMS = {
    "burst": ["device_window_minutes", "min_anomalies"],
    "dominant_family": ["family", "min_percent"],
    **{t: ["tag", "route"] for t in TAG_TYPES},
}

# A rules table is configuration; far more rows than this are a mistake.
MAX_RULES = 10_000


@dataclass(frozen=True)
class Rule:
    id: str
    type: str
    enabled: bool = True
    severity: str = ""
    message: str = ""
    params: dict = field(default_factory=dict)

    @property
    def min_score(self) -> float | None:
        value = self.params.get("min_score")
        return None if value is None else float(value)


@dataclass(frozen=True)
class RuleDefaults:
    """What holds for rules that say nothing else: the least score of a row, and the severity."""
    min_score: float | None = None
    severity: str = "INFO"

    def fill(self, rule: Rule) -> Rule:
        params = rule.params if rule.min_score is not None or self.min_score is None else {**rule.params, "min_score": self.min_score}
        return replace(rule, severity=(rule.severity or self.severity).upper(), params=params)


@dataclass(frozen=True)
class FamilyRule:
    """All required families must reach the percentage."""
    name: str = ""
    root_cause: str = ""
    required_families: tuple[str, ...] = ()
    min_family_percent: float = 0.0
    id: str = ""
    message: str = ""


def check_rule(rule: Rule, position: int = 0) -> Rule:
    kind = (rule.type or "").strip()
    if not kind:
        raise ValueError(f"Rule {position} has no 'type'")
    if kind not in REQUIRED_PARAMS:
        raise ValueError(f"Rule {position} has unknown type '{kind}'; known: {sorted(REQUIRED_PARAMS)}")
    absent = [p for p in REQUIRED_PARAMS[kind] if rule.params.get(p) in (None, "")]
    if absent:
        raise ValueError(f"Rule {position} of type '{kind}' needs {absent}")
    return rule


def rules_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [(r.id, r.type, r.enabled, r.severity, r.message,
             {k: str(v) for k, v in r.params.items()}) for r in rules]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def read_rules(table: DataFrame) -> list[Rule]:
    """Checked rules of a table; every rule is checked, enabled or not.

    ``name`` and ``cause`` are other names of ``id`` and ``message``, taken where those are missing.
    """
    for field_name, other in (("id", "name"), ("message", "cause")):
        if other in table.columns:
            own = F.col(field_name) if field_name in table.columns else F.lit(None).cast("string")
            table = table.withColumn(field_name, F.coalesce(own, F.col(other)))
    rows = table.select(*RULE_SCHEMA.names).limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return [check_rule(Rule(r.id or "", (r.type or "").strip(), r.enabled is not False,
                            (r.severity or "").upper(), r.message or "", r.params or {}), i)
            for i, r in enumerate(rows)]


def family_rule(rule: Rule) -> FamilyRule:
    """The dominant-family form of a table rule."""
    return FamilyRule(name=rule.id, root_cause=rule.message, id=rule.id,
                      required_families=(rule.params["family"],),
                      min_family_percent=float(rule.params["min_percent"]))
