"""Policies: small TOML or JSON files with closed keys, read on the driver and used as literals or broadcast rows."""

from __future__ import annotations

import hashlib
import json
import tomllib
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: The alignment policy's keys and the kinds of its values.
ALIGNMENT = {"max_characters": int, "max_character_pairs": int, "timeout_seconds": int}


def load(path: str, keys: dict[str, type]) -> tuple[dict[str, Any], str]:
    """A policy's values and the digest of its bytes. A missing, unknown or mistyped key is refused."""
    raw = Path(path).read_bytes()
    values = json.loads(raw) if path.endswith(".json") else tomllib.loads(raw.decode())
    if set(values) != set(keys):
        raise ValueError(f"keys differ from the closed set: {sorted(set(values) ^ set(keys))}")
    wrong = [k for k, kind in keys.items() if not isinstance(values[k], kind) or isinstance(values[k], bool) and kind is not bool]
    if wrong:
        raise ValueError(f"values of another kind: {wrong}")
    return values, hashlib.sha256(raw).hexdigest()


def _closed(value: Any, keys: set[str], what: str) -> dict[str, Any]:
    if not isinstance(value, dict) or set(value) != keys:
        raise ValueError(f"{what}: keys")
    return value


def _number(value: Any, least: int, what: str) -> int:
    if not isinstance(value, int) or isinstance(value, bool) or value < least:
        raise ValueError(what)
    return value


def _text(value: Any, what: str) -> str:
    if not isinstance(value, str) or not value.strip():
        raise ValueError(what)
    return value


def _alignment(p: dict[str, Any]) -> None:
    for k, v in _closed(_closed(p, {"limits"}, "alignment")["limits"], set(ALIGNMENT), "limits").items():
        _number(v, 1, k)


def _recovery(p: dict[str, Any]) -> None:
    budget = _closed(_closed(p, {"absolute_cap", "budget"}, "recovery")["budget"], {"fallback_recrop", "page_level_reread"}, "budget")
    cap, kinds = _number(p["absolute_cap"], 0, "absolute_cap"), [_number(v, 0, k) for k, v in budget.items()]
    if cap > MOST_RECOVERIES or sum(kinds) > cap:
        raise ValueError("over the absolute cap")


def _padding(p: dict[str, Any]) -> None:
    table = _closed(_closed(p, {"padding"}, "padding")["padding"], {"top_bp", "right_bp", "bottom_bp", "left_bp", "provenance"}, "padding")
    for k in ("top_bp", "right_bp", "bottom_bp", "left_bp"):
        _number(table[k], 0, k)
    _text(_closed(table["provenance"], {"source", "caveat"}, "provenance")["source"], "source")
    _text(table["provenance"]["caveat"], "caveat")


def _hard_failure(p: dict[str, Any]) -> None:
    from lectern.operators.accounting import ALGEBRA

    if _number(_closed(p, {"threshold", "kind"}, "hard failure")["threshold"], 0, "threshold") != HARD_FAILURES:
        raise ValueError("threshold")
    if not isinstance(p["kind"], list) or not p["kind"]:
        raise ValueError("no kinds")
    seen = set()
    for kind in p["kind"]:
        if not isinstance(kind, dict) or set(kind) not in ({"stage", "outcome"}, {"stage", "outcome", "reason"}):
            raise ValueError("kind: keys")
        if (kind["stage"], kind["outcome"], "failed") not in {(s, o, c) for s, o, c, _ in ALGEBRA}:
            raise ValueError("no failure of that stage")
        if "reason" in kind:
            _text(kind["reason"], "reason")
        row = tuple(sorted(kind.items()))
        if row in seen:
            raise ValueError("kind twice")
        seen.add(row)


def _tiles(p: dict[str, Any]) -> None:
    table = _closed(_closed(p, {"tiles"}, "tiles")["tiles"], {"width_px", "height_px", "vertical_offset_px", "horizontal_overlap_px"}, "tiles")
    for k, v in table.items():
        _number(v, 1, k)
    if table["vertical_offset_px"] * 2 != table["height_px"] or table["horizontal_overlap_px"] * 2 != table["width_px"]:
        raise ValueError("not half a tile")


#: The most recoveries of an act, and the failures at which a run is warned of.
MOST_RECOVERIES, HARD_FAILURES = 3, 2
POLICIES = {"alignment": _alignment, "recovery": _recovery, "padding": _padding, "hard-failure": _hard_failure, "tiles": _tiles}


def fault(kind: str, text: str | None) -> str | None:
    """What keeps a policy's TOML from being taken: unreadable, a key too many or too few, a value that isn't allowed; None if nothing."""
    if kind not in POLICIES:
        return "unknown policy"
    try:
        POLICIES[kind](tomllib.loads(text or ""))
    except tomllib.TOMLDecodeError:
        return "unreadable"
    except ValueError as e:
        return str(e)
    return None


@pandas_udf(StringType())
def policy_fault(kind: pd.Series, text: pd.Series) -> pd.Series:
    return pd.Series([fault(k, t) for k, t in zip(kind, text, strict=True)], dtype=object)


def as_rows(spark: SparkSession, values: dict[str, Any]) -> DataFrame:
    """(key, value): a row for each key of a policy, for a broadcast join."""
    return spark.createDataFrame([(k, str(v)) for k, v in sorted(values.items())], "key string, value string")
