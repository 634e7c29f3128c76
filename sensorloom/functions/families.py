"""From a feature name to the sensor family operators know."""

from sensorloom.schema import SIGNALS

# Display family of each signal.
SIGNAL_FAMILY = {
    "rpm": "RPM",
    "temp_c": "Temperature",
    "vibration_g": "Vibration",
    "current_a": "Current",
    "voltage_v": "Voltage",
}

# Families of features that no signal owns, in order of precedence, with the
# beginnings and the parts of a lower-case name that belong to them.
NAMED_FAMILIES = (
    ("Error/Flags", ("error",), ("error_code", "flag")),
    ("State", ("state",), ("transition",)),
    ("Time", ("time", "ts_"), ("timestamp",)),
)
REST = "Other"


def _owner(feature: str, signals) -> str | None:
    """The longest signal that the feature is named after."""
    return max((s for s in signals if feature.startswith(f"{s}_")), key=len, default=None)


def sensor_family(feature: str, signals=None) -> str:
    """Family of a feature; resolved once per column name while planning."""
    owner = _owner(feature, SIGNALS if signals is None else signals)
    if owner is not None:
        return SIGNAL_FAMILY.get(owner, owner)
    name = feature.lower()
    return next((family for family, starts, parts in NAMED_FAMILIES
                 if name.startswith(starts) or any(part in name for part in parts)), REST)


def families_of(features, signals=None) -> dict[str, list[str]]:
    """Features of each family, families in name order."""
    members: dict[str, list[str]] = {}
    for feature in features:
        members.setdefault(sensor_family(feature, signals), []).append(feature)
    return dict(sorted(members.items()))
