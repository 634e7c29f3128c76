"""Which features and sensor families push a reading away from normal."""

from pyspark.sql import DataFrame, functions as F

from sensorloom.functions.families import families_of
from sensorloom.functions.scalars import normalize_tag

UNLABELED = "(unlabeled)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def contributions(z: DataFrame, features, k: int = 5, signals=None) -> DataFrame:
    """Standard scores replaced by ``top_features``, ``family_totals`` and ``families_sorted``.

    The share of a feature is |z| over the sum of all |z|, in percent; ties keep column
    order, families tie by name.  The scores of a row become one array and families are lists
    of positions in it, resolved while planning, so nothing is exploded or shuffled and the
    generated code stays small however many features there are.
    """
    keep = [f"`{c}`" for c in z.columns if c not in set(features)]
    place = {f: i for i, f in enumerate(features)}
    families = families_of(features, signals)
    names = f"array({', '.join(_text(f) for f in features)})"
    groups = ", ".join(f"named_struct('i', {i}, 'name', {_text(name)}, 'at', array({', '.join(str(place[f]) for f in members)}))"
                       for i, (name, members) in enumerate(families.items()))
    percent = lambda part: f"try_divide({part}, _total) * 100D AS pct"
    # Structs of (pct, -position, name), so that descending order breaks ties by position.
    by_feature = f"transform(_s, (x, i) -> struct({percent('x')}, -i AS early, {names}[i] AS name))"
    by_family = (f"transform(array({groups}), g -> struct("
                 f"{percent('aggregate(g.at, 0D, (sum, j) -> sum + _s[j])')}, -g.i AS early, g.name AS name))")
    rows = (z.selectExpr(*keep, f"transform(array({', '.join(f'CAST(`{f}` AS DOUBLE)' for f in features)}), "
                                "x -> CASE WHEN abs(x) < double('Infinity') THEN abs(x) ELSE 0D END) AS _s")
            .selectExpr("*", "aggregate(_s, 0D, (sum, x) -> sum + x) AS _total")
            .selectExpr(*keep, "_total > 0 AS _known", f"slice(sort_array({by_feature}, false), 1, {k}) AS _f",
                        f"sort_array({by_family}, false) AS _g"))
    listed = lambda column, name: (
        f"CAST(CASE WHEN _known THEN arrays_zip({column}.name, {column}.pct) ELSE array() END "
        f"AS array<struct<{name}:string,pct:double>>)")
    return rows.selectExpr(
        *keep, f"{listed('_f', 'feature')} AS top_features",
        "CASE WHEN _known THEN map_from_arrays(_g.name, _g.pct) ELSE CAST(map() AS map<string,double>) END AS family_totals",
        f"{listed('_g', 'family')} AS families_sorted")


def explain_rows(z: DataFrame, features, k: int = 5, pred: str = "pred",
                 tag: str = "anomaly_tag", signals=None) -> DataFrame:
    """Explanations of flagged rows; ``z`` carries row columns and standardized features."""
    shown = normalize_tag(F.col(tag))
    flagged = z.where(F.col(pred) == 1).withColumn(
        tag, F.when(shown == "", F.lit(UNLABELED)).otherwise(shown))
    return contributions(flagged, features, k, signals)
