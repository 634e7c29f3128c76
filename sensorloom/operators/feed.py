"""Read-side queries over stored alerts and aggregates."""

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.functions.scalars import parse_time

# Default and largest page of each feed.
ALERT_LIMIT, MAX_ALERTS = 200, 2000
AGGREGATE_LIMIT, MAX_AGGREGATES = 500, 5000


def _page(limit: int, largest: int) -> int:
    if not 1 <= limit <= largest:
        raise ValueError(f"limit must be between 1 and {largest}")
    return limit


def _text(df: DataFrame, name: str) -> Column:
    column = F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")
    return F.trim(F.coalesce(column, F.lit("")))


def with_alert_id(df: DataFrame, position: str = "pos") -> DataFrame:
    """``alert_id``: a given one, else ``id``, else rule:device:time, else the file position."""
    given, other = _text(df, "alert_id"), _text(df, "id")
    rule, device, time = (_text(df, c) for c in ("rule_id", "device_id", "timestamp"))
    composed = F.when((rule != "") & (device != "") & (time != ""), F.concat_ws(":", rule, device, time))
    last = F.concat(F.lit("idx:"), F.col(position).cast("string"))
    return df.withColumn("alert_id", F.coalesce(
        F.nullif(given, F.lit("")), F.nullif(other, F.lit("")), composed, last))


def alert_feed(df: DataFrame, device: str | None = None, severity: str | None = None,
               route: str | None = None, since: str | None = None, limit: int = ALERT_LIMIT,
               position: str = "pos") -> DataFrame:
    """Newest alerts first; alerts without a time come last and drop out where ``since`` is set."""
    _page(limit, MAX_ALERTS)
    rows = with_alert_id(df, position)
    time = parse_time(_text(df, "timestamp"))
    if device:
        rows = rows.where(_text(df, "device_id") == device)
    if severity:
        rows = rows.where(F.lower(_text(df, "severity")) == severity.strip().lower())
    if route:
        rows = rows.where(F.lower(_text(df, "route")) == route.strip().lower())
    if since:
        bound = parse_time(F.lit(since))
        rows = rows.where(bound.isNull() | F.coalesce(time >= bound, F.lit(False)))
    return rows.orderBy(time.desc_nulls_last(), position).limit(limit)


def alert_by_id(df: DataFrame, alert_id: str, position: str = "pos") -> DataFrame:
    """The first alert of that id in file order."""
    rows = with_alert_id(df, position)
    return rows.where(F.col("alert_id") == alert_id).orderBy(position).limit(1)


def _path(name: str) -> str:
    """A path as it is; a plain key, whatever its characters, as the path of that key."""
    if name.startswith("$"):
        return name
    if "'" in name and '"' in name:
        raise ValueError("a key with both kinds of quotes cannot be a path")
    return f'$["{name}"]' if "'" in name else f"$['{name}']"


def open_order(body: Column, name: str) -> Column:
    """Order of values of mixed types at a path: numbers and truth values (missing: -1), then texts, then lists and objects as JSON."""
    value = F.try_variant_get(body, _path(name), "variant")
    kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    truth = F.try_variant_get(value, "$", "boolean").cast("double")
    number = F.coalesce(F.when(kind == "BOOLEAN", truth).otherwise(F.try_variant_get(value, "$", "double")), F.lit(-1.0))
    nested = kind.startswith("ARRAY") | kind.startswith("OBJECT")
    text = F.when(kind == "STRING", F.try_variant_get(value, "$", "string")).when(nested, F.to_json(value))
    rank = F.when(kind == "STRING", 1).when(nested, 2).otherwise(0)
    return F.struct(rank.alias("rank"), F.when(rank == 0, number).alias("number"), text.alias("text"))


def aggregate_feed(df: DataFrame, sort_by: str = "device_id", desc: bool = False,
                   limit: int = AGGREGATE_LIMIT) -> DataFrame:
    """Summaries sorted by any key, equal ones by device.

    A column counts by its type; a missing number is -1, a missing text ''. Any other key, or a path such as ``$.site.load``, is looked up
    in the open object ``body`` (see :func:`open_order`). A key that no summary has leaves the order of devices.
    """
    _page(limit, MAX_AGGREGATES)
    rows, types = df.where("device_id IS NOT NULL"), dict(df.dtypes)
    if types.get(sort_by) == "string":
        key = F.coalesce(sort_by, F.lit(""))
    elif sort_by in types and not types[sort_by].startswith(("array", "map", "struct", "variant")):
        key = F.coalesce(F.col(sort_by), F.lit(-1))
    elif "body" in types:
        key = open_order(F.col("body"), sort_by)
    elif sort_by in types:
        raise ValueError(f"cannot sort by {sort_by}")
    else:
        return rows.orderBy("device_id").limit(limit)
    return rows.orderBy(key.desc() if desc else key.asc(), "device_id").limit(limit)


def aggregate_by_device(df: DataFrame, device: str) -> DataFrame:
    return df.where(F.col("device_id") == device)
