"""Routing of a decision by its metadata: keys and the specialist of the first profile that fits."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from juriflow.functions.text import class_family, first_of, slug

# The shipped profiles.
PROFILES = (
    {"name": "mandado_seguranca", "when": {"class_family": "mandado_seguranca"}, "specialist": "ms_specialist"},
    {"name": "cumprimento_sentenca", "when": {"class_family": "cumprimento_sentenca"}, "specialist": "cumprimento_specialist"},
)
DEFAULT = "global_teacher"


def load_profiles(path: str) -> tuple[dict, ...]:
    """Profiles of a JSON file; none if it can't be read."""
    try:
        with open(path, encoding="utf-8") as f:
            return tuple(json.load(f).get("profiles", []))
    except (OSError, ValueError, AttributeError):
        return ()


def specialist(family: Column, profiles: tuple[dict, ...] = PROFILES) -> Column:
    cases = []
    for p in profiles:
        wanted = (p.get("when") or {}).get("class_family")
        cases.append((family == wanted if wanted else F.lit(True), p.get("specialist") or DEFAULT))
    return first_of(cases, F.lit(DEFAULT)) if cases else F.lit(DEFAULT)


def route(df: DataFrame, profiles: tuple[dict, ...] = PROFILES) -> DataFrame:
    """df with class_family, region_key, orgao_key, route_key and specialist."""
    keyed = df.withColumns(
        {"class_family": class_family(F.col("classe")), "region_key": slug(F.col("secao_subsecao"), 60), "orgao_key": slug(F.col("orgao_julgador"), 80)}
    )
    return keyed.withColumns(
        {"route_key": F.concat_ws("|", "class_family", "region_key", "orgao_key"), "specialist": specialist(F.col("class_family"), profiles)}
    )
